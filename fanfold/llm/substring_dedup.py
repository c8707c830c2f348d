"""Remove bytes covered by a long string that also starts earlier in the corpus.

Exact for every string of ``LENGTH`` bytes, without bringing texts together:

1. Anchors.  Of the 32-byte grams in a window of LENGTH bytes the one with the least
   hash is its anchor, so equal windows have equal anchors at equal places.  Windows in
   a row with one anchor form a segment; a shuffle by the anchor's hash brings the
   digests of segments together (about one row for 35 bytes of text).
2. A segment that equals one that starts earlier is covered wholly.  Of each text of
   segments the earliest stays; where an anchor has several, they differ at some end.
3. Those earliest segments are sorted in blocks as suffix arrays (suffix_sort): small
   suffixes directly, the rest induced, then adjacent common prefixes.  Neighbours that
   share LENGTH bytes are one string, and all but its first start are covered.

Equal segments that meet in one input batch are reduced to their earliest there, so a
passage that a third of all documents holds reaches the shuffle as one row a batch.
Where such a passage begins or ends, segments hold bytes of each document's own and all
differ.  So a first scan counts the different segments of each anchor and input batch;
anchors that reach more than HOT are hot.  Their segments are split into single windows,
whose own digests take the anchor's place: equal windows meet in one group, reduced to
one row a batch as well, and are settled without sorting.  An anchor that escapes the
count, as it has one segment in most batches, has about sqrt(HOT * batches) of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LENGTH, GRAM = 100, 32
SPREAD = LENGTH - GRAM + 1
#: About this many bytes of segments are sorted as one suffix array.
BLOCK_BYTES = 2 << 20
BUFFER_BYTES = 1 << 20
HOT = 4096
#: Ids that have several texts are broadcast up to this many.
BROADCAST_ROWS = 100_000
#: Hot anchors are collected and broadcast up to this many (8 MB); beyond, they are joined.
BROADCAST_ANCHORS = 1 << 20
#: The documents of one anchor meet it in so many groups.
SALTS = 64
LAST_ID = (1 << 63) - 1


def _grams(buffer):
    """Hashes of the GRAM bytes from each place on."""
    import numpy as np

    from .shingles import mixed

    padded = np.concatenate([buffer, np.zeros(GRAM + 8, dtype=np.uint8)])
    n = len(buffer)
    words = np.empty(n + GRAM, dtype=np.uint64)
    for k in range(8):
        m = len(range(k, n + GRAM, 8))
        words[k::8] = np.concatenate([padded[k:], np.zeros(8, dtype=np.uint8)])[: 8 * m].view("<u8")
    total = np.zeros(n, dtype=np.uint64)
    for k, step in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        total += words[8 * k : 8 * k + n] * np.uint64(step)
    return mixed(total)


def segments(texts: list[bytes], hot=None):
    """(text, start, windows, anchor hash, digest) as arrays: the segments of texts.  Those
    of ``hot`` anchors, a sorted array, are split into windows."""
    import numpy as np

    from .shingles import mixed

    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.empty(0, dtype=np.int64)
    if not len(buffer) or sizes.max() < LENGTH:
        return none, none, none, none, none
    gram = _grams(buffer)
    low = np.uint64(0xFFFFFFFF)
    best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    wide, span = best, 1
    while 2 * span <= SPREAD:  # least over [i, i + span)
        wide = np.minimum(wide[: len(wide) - span], wide[span:])
        span *= 2
    n = len(buffer) - LENGTH + 1
    anchor = (np.minimum(wide[:n], wide[SPREAD - span : SPREAD - span + n]) & low).astype(np.int64)
    # windows that lie in one text
    owner = np.repeat(np.arange(len(texts)), np.maximum(sizes - LENGTH + 1, 0))
    counts = np.maximum(sizes - LENGTH + 1, 0)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = place + (ends - sizes)[owner]
    own = anchor[at]
    first = (np.diff(own, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0)
    head = np.flatnonzero(first)
    windows = np.diff(head, append=len(own))
    single = np.zeros(len(head), dtype=bool)
    if hot is not None and len(hot):
        names = gram[own[head]].view(np.int64)
        single = hot[np.minimum(np.searchsorted(hot, names), len(hot) - 1)] == names
        split = np.repeat(single, windows)
        head = np.flatnonzero(first | split)
        single, windows = split[head], np.diff(head, append=len(own))
    start, mark = at[head], own[head]
    last = start + windows - 1 + LENGTH - GRAM
    digest = mixed(windows.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + (mark - start).astype(np.uint64)) + gram[last]
    for k in range(0, LENGTH + SPREAD, GRAM):
        digest = mixed(digest * np.uint64(0xE7037ED1A0B428DB) + gram[np.minimum(start + k, last)])
    anchor = np.where(single, mixed(gram[mark] ^ digest), gram[mark])
    return owner[head], place[head], windows, anchor.view(np.int64), digest.view(np.int64)


def _segments_of(texts: list[bytes], hot=None):
    """``segments`` of the texts of a batch, a slice of BUFFER_BYTES at a time."""
    import numpy as np

    found, part, size, base = [], [], 0, 0
    for i, t in enumerate([*texts, None]):
        if part and (t is None or size + len(t) > BUFFER_BYTES):
            own, *rest = segments(part, hot)
            found.append((own + base, *rest))
            part, size, base = [], 0, i
        if t is not None:
            part.append(t)
            size += len(t)
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def hot_anchors(docs: DataFrame) -> DataFrame:
    """``(anchor)``: those with more than HOT segments, as far as several different ones
    meet in an input batch; at most one for HOT segments of the corpus."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            _, _, _, anchor, digest = _segments_of(batch.column(0).to_pylist())
            order = np.lexsort((digest, anchor))
            anchor, digest = anchor[order], digest[order]
            new = np.ones(len(anchor), dtype=bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
            anchor, n = np.unique(anchor[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor[n > 1]), pa.array(n[n > 1])], ["anchor", "n"])

    counts = docs.select("bytes").mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") > HOT).select("anchor")


def with_own_hot(docs: DataFrame, hot: DataFrame) -> DataFrame:
    """``docs(key, doc, bytes)`` with ``hot``: the anchors of ``hot`` that each document has.
    Nothing is broadcast; the documents of one anchor are dealt to SALTS groups."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keys, docs_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            own, _, _, anchor, _ = _segments_of(batch.column(2).to_pylist())
            order = np.lexsort((anchor, own))
            own, anchor = own[order], anchor[order]
            new = np.ones(len(own), dtype=bool)
            new[1:] = (own[1:] != own[:-1]) | (anchor[1:] != anchor[:-1])
            own, anchor = own[new], anchor[new]
            yield pa.RecordBatch.from_arrays([pa.array(keys[own]), pa.array(docs_[own]), pa.array(anchor)], ["key", "doc", "anchor"])

    salt = F.pmod(F.xxhash64("key", "doc"), F.lit(SALTS)).cast("int")
    held = docs.select("key", "doc", "bytes").mapInArrow(run, "key long, doc long, anchor long").withColumn("salt", salt)
    dealt = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = held.join(dealt, ["anchor", "salt"]).groupBy("key", "doc").agg(F.collect_set("anchor").alias("hot"))
    return docs.join(own, ["key", "doc"], "left").select("key", "doc", "bytes", "hot")


def scan(docs: DataFrame, hot=None) -> DataFrame:
    """``(anchor, digest, key, doc, start, windows, copy)`` from ``docs(key, doc, bytes)``;
    ``copy``: the same segment starts earlier in the same input batch.  Repeated rows of one
    document give its segments once a batch; copies in a row are one row.  ``hot`` is a
    broadcast of the sorted hot anchors; without it ``docs`` has a column of them, so that
    those of a batch are all that its texts can meet."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keys, docs_ = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            names = hot.value if hot is not None else np.unique(batch.column(3).flatten().to_numpy(zero_copy_only=False))
            own, start, windows, anchor, digest = _segments_of(batch.column(2).to_pylist(), names)
            key, doc = keys[own], docs_[own]
            order = np.lexsort((start, doc, key, digest, anchor))
            anchor, digest, key, doc, start, windows = (c[order] for c in (anchor, digest, key, doc, start, windows))
            copy = np.zeros(len(order), dtype=bool)
            copy[1:] = (anchor[1:] == anchor[:-1]) & (digest[1:] == digest[:-1])
            again = np.zeros(len(order), dtype=bool)
            again[1:] = copy[1:] & (key[1:] == key[:-1]) & (doc[1:] == doc[:-1]) & (start[1:] == start[:-1])
            columns = [c[~again] for c in (anchor, digest, key, doc, start, windows)]
            copy = copy[~again]
            one = [c[~copy] for c in columns]
            # copies in a row are one run
            anchor, digest, key, doc, start, windows = (c[copy] for c in columns)
            order = np.lexsort((start, doc, key))
            anchor, digest, key, doc, start, windows = (c[order] for c in (anchor, digest, key, doc, start, windows))
            head = np.ones(len(order), dtype=bool)
            head[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + windows[:-1])
            head = np.flatnonzero(head)
            runs = [*(c[head] for c in (anchor, digest, key, doc, start)), np.add.reduceat(windows, head) if len(head) else windows]
            columns = [np.concatenate(c) for c in zip(one, runs, strict=True)]
            copy = np.repeat([False, True], [len(one[0]), len(head)])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*columns[:4], columns[4].astype(np.int32), columns[5].astype(np.int32), copy)], ["anchor", "digest", "key", "doc", "start", "windows", "copy"])

    return docs.mapInArrow(run, "anchor long, digest long, key long, doc long, start int, windows int, copy boolean")


def cut_out(texts: DataFrame, n_blocks: int) -> DataFrame:
    """``(block, key, doc, start, part)``: the bytes of the segments that are to be sorted,
    by block; ``texts`` has ``(key, doc, bytes, todo)``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, doc, raw, todo in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for s in todo:
                    a, n = s["start"], s["windows"]
                    out.append((s["anchor"] % n_blocks, key, doc, a, raw[a : a + n - 1 + LENGTH]))
            columns = list(zip(*out, strict=True)) or [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["block", "key", "doc", "start", "part"])

    return texts.select("key", "doc", "bytes", "todo").mapInArrow(run, "block long, key long, doc long, start int, part binary")


def covered_windows(parts: list[bytes], key, doc, start):
    """(key, doc, start, windows): runs of the windows of ``parts`` that also start earlier,
    by the order of (key, doc, start); found by sorting all suffixes of the parts."""
    import numpy as np

    from .suffix_sort import common_prefixes, joined, suffix_array

    text, begins = joined(parts)
    order = suffix_array(text, LENGTH)
    part = np.searchsorted(begins, order, side="right") - 1
    inside = order - begins[part]
    sizes = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    whole = inside <= sizes[part] - LENGTH
    order, part, inside = order[whole], part[whole], inside[whole]
    string = np.cumsum(common_prefixes(order, text, LENGTH) < LENGTH)
    k, d, at = key[part], doc[part], start[part] + inside
    by = np.lexsort((at, d, k, string))
    string, k, d, at, part, inside = (x[by] for x in (string, k, d, at, part, inside))
    head = np.flatnonzero(np.diff(string, prepend=-1))
    own = np.repeat(head, np.diff(head, append=len(string)))
    later = (k != k[own]) | (d != d[own]) | (at != at[own])
    part, inside = part[later], inside[later]
    by = np.lexsort((inside, part))
    part, inside = part[by], inside[by]
    head = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(inside, prepend=-9) != 1))
    return key[part[head]], doc[part[head]], start[part[head]] + inside[head], np.diff(head, append=len(part))


def sorted_blocks(cut: DataFrame) -> DataFrame:
    """``(key, doc, start, windows)``: covered windows of the cut segments, block by block."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        key, doc, start, n = covered_windows(table["part"].to_pylist(), table["key"].to_numpy(), table["doc"].to_numpy(), table["start"].to_numpy().astype(np.int64))
        return pa.table({"key": pa.array(key, pa.int64()), "doc": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int32()), "windows": pa.array(n, pa.int32())})

    return cut.groupBy("block").applyInArrow(run, "key long, doc long, start int, windows int")


def _spans(windows: DataFrame) -> DataFrame:
    """``(key, doc, spans)``: runs of windows as the maximal spans of bytes that they cover,
    in order; one shuffle, by document."""
    ordered = Window.partitionBy("key", "doc").orderBy("start")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    runs = windows.select("key", "doc", "start", (F.col("start") + F.col("windows") - 1 + LENGTH).cast("int").alias("end"))
    runs = runs.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1))
    runs = runs.withColumn("span", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = runs.groupBy("key", "doc", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return spans.groupBy("key", "doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def _without(raw: str):
    """The bytes of column ``raw`` outside its ``spans``, joined once as hexadecimal text."""
    froms = F.concat(F.array(F.lit(0)), F.col("spans.end"))
    to = F.concat(F.col("spans.start"), F.array(F.octet_length(raw)))
    return F.unhex(F.array_join(F.zip_with(froms, to, lambda a, b: F.hex(F.substring(F.col(raw), a + 1, b - a))), ""))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, key, doc, bytes)`` per row; (key, doc) names a document.  ``doc`` is the
    text's digest where the id is null or has several texts, else 0, which shuffles well."""
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("bytes"))
    digest = F.xxhash64("bytes")
    shared = stored(text.where("id IS NOT NULL").select("key", digest.alias("d")).groupBy("key").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where("lo <> hi").select("key"), "shared")
    n = shared.count()
    if not n:
        return text.withColumn("doc", F.when(F.col("id").isNull(), digest).otherwise(F.lit(0).cast("long")))
    shared = F.broadcast(shared) if n <= BROADCAST_ROWS else shared
    own = F.col("id").isNull() | F.col("several")
    return text.join(shared.withColumn("several", F.lit(True)), "key", "left").withColumn("doc", F.when(own, digest).otherwise(F.lit(0).cast("long")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, spans, kept)`` per row of ``docs``: the maximal covered spans of
    the text's UTF-8 bytes and the bytes that remain.

    Ids are whole numbers, and smaller ids are earlier.  Rows of one id and text are one
    document and get the same spans.  Different texts of one id are documents of their own,
    by their digests; so are the texts without an id, which come last.  A null text has no
    bytes, and one of under LENGTH bytes keeps all.  Texts of any length are read whole, in
    time that grows with their bytes and spans; further columns are not read; an empty table
    gives an empty result."""
    text = _documents(docs, id_col, text_col)
    hot = stored(hot_anchors(text), "hot")
    if hot.count() <= BROADCAST_ANCHORS:
        names = hot.orderBy("anchor").toPandas()["anchor"].to_numpy(dtype="int64")
        found = scan(text.select("key", "doc", "bytes"), docs.sparkSession.sparkContext.broadcast(names))
    else:
        found = scan(with_own_hot(text, hot))
    apart = F.when(F.col("copy"), F.xxhash64("key", "doc", "start")).otherwise(F.lit(0))
    found = found.withColumn("apart", apart)
    of_anchor, of_segment = Window.partitionBy("anchor", "apart"), Window.partitionBy("anchor", "apart", "digest")
    place = F.struct("key", "doc", "start")
    met = (
        found.withColumn("first", F.min(place).over(of_segment))
        .withColumn("n", F.count("*").over(of_anchor))
        .withColumn("several", F.min("digest").over(of_anchor) != F.max("digest").over(of_anchor))
        .where("copy OR n > 1")
        .withColumn("covered", F.col("copy") | (F.col("first") != place))
        .where("covered OR several")
        .select("key", "doc", "start", "windows", "anchor", "covered")
    )
    marks = stored(met, "marks")
    size = marks.where("NOT covered").agg(F.sum(F.col("windows") + LENGTH)).first()[0] or 0
    todo = marks.where("NOT covered").groupBy("key", "doc").agg(F.collect_set(F.struct("anchor", "start", "windows")).alias("todo"))
    texts = text.select("key", "doc", "bytes", "id")
    more = sorted_blocks(cut_out(texts.join(todo, ["key", "doc"]).dropDuplicates(["key", "doc"]), 1 + size // BLOCK_BYTES))
    every = marks.where("covered").select("key", "doc", "start", "windows").unionByName(more)
    none = F.array().cast("array<struct<start:int,end:int>>")
    done = texts.join(_spans(every), ["key", "doc"], "left").select("id", "bytes", F.coalesce("spans", none).alias("spans"))
    kept = F.when(F.size("spans") == 0, F.col("bytes")).otherwise(_without("bytes"))
    return done.select(F.col("id").alias(id_col), F.octet_length("bytes").cast("long").alias("n_bytes"), "spans", kept.alias("kept"))
