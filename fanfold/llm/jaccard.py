"""N-gram Jaccard join: documents whose sets of five-word shingles are alike.

Equal sets are one class; the join runs on classes, and copies never meet in pairs.
Candidates come from token-combination prefixes.  A class orders its tokens (shingle
hashes): rare ones first, frequent ones next, very frequent ones last.  Rare tokens are
indexed singly; the others are dealt to groups, and the pairs of frequent and the triples
of very frequent tokens of a group are indexed.  A prefix is long enough when

    rare tokens + sum over groups of (tokens - (k - 1))  >=  floor((1 - t) * size) + 1,

with k = 2 or 3, for then two sets with Jaccard similarity t or more, of which at most
floor((1 - t) * size) tokens of one are missing in the other, share a rare token or k
tokens of one group within both prefixes.  Groups grow with the size of the set, so that a
group holds five or six prefix tokens and the index stays linear in the text; sizes differ
by at most 1 / t, so each set is indexed under its own size band and the one below.

Each entry of the index knows the greatest size that a partner may have.  A pair that is
alike shares some entry within prefixes only as long as its own two sizes ask for; so an
entry that ends where the sum above is u serves pairs that share n - u + 1 tokens or more,
which bounds the partner's size, and loses none.

A small bucket of the index (classes with one signature) gives the pairs that may be
partners.  A large one is not expanded: every member is verified against the bucket's
first; where it then still spans several components, one member of each is verified
against one of the first, others in every round.  What members of different components
are then left, and may be partners, are verified against each other, so components are
exact.  Pairs first meet as sizes and parity sketches, which rule out most that aren't
alike and none that is; texts are fetched and compared for the rest, first for one pair of
each class, then for those that are still apart.

Members of a large bucket that meet within one input batch are reduced to their first
there, so a signature that a third of all documents share reaches its bucket as one row
for each batch.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import let, removed, slices, stored
from .components import components

#: Similarity of 80 %, in whole numbers as the contract states it.
PERCENT = 80
#: A token is frequent in more classes than FREQUENT and than this share of all
#: documents, and very frequent in more than VERY_FREQUENT and its share.
FREQUENT, FREQUENT_SHARE = 8, 0.0001
VERY_FREQUENT, VERY_FREQUENT_SHARE = 64, 0.01
#: So many frequent tokens are broadcast at most (9 bytes each); more raise the limit above.
MAX_FREQUENT = 2_000_000
GROUP_TOKENS = 4
#: Buckets of up to so many classes give their pairs at once.
SMALL = 6
#: Members of a signature that are reduced to their first when more meet in one batch.
HOT_BATCH = 16
#: A parity sketch has at least this many numbers of 64 bits, and two bits for each token.
SKETCH = 16
#: Ids of texts to fetch are broadcast up to this number of rows (16 bytes each).
BROADCAST_ROWS = 200_000
#: Rounds of star verification before members meet pair by pair; they only save work.
STAR_ROUNDS = 4
#: Texts that are hashed at once: bounds the memory of a Python worker.
SLICE_BYTES = 4 << 20
BAND = math.log(100 / PERCENT)


def _missing(n: int) -> int:
    return n * (100 - PERCENT) // 100


def _groups(band: int) -> int:
    return max(1, int(0.01 * (100 - PERCENT) * (100 / PERCENT) ** band) // GROUP_TOKENS)


def _partner(n: int, shared):
    """The greatest size of a set alike to one of ``n`` tokens that shares ``shared`` at most."""
    return (100 + PERCENT) * shared // PERCENT - n


def signatures(tokens, frequent, level):
    """``(signatures, greatest partner sizes)`` of one set: ``tokens`` sorted and distinct,
    ``frequent`` the sorted frequent tokens and ``level`` how many of each make a
    combination.  Sets of fewer than four tokens link with equal ones only."""
    import numpy as np

    from .shingles import mixed

    n = len(tokens)
    if n < 4:
        return tokens[:0], np.empty(0, dtype=np.int64)
    need = _missing(n) + 1
    k = np.ones(n, dtype=np.int64)
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        hit = frequent[at] == tokens
        k[hit] = level[at[hit]]
    rare = tokens[k == 1][:need]
    sigs, sizes = [rare], [_partner(n, n - np.arange(len(rare)))]
    if len(rare) == need:
        return rare, sizes[0]
    order = np.argsort(k, kind="stable")[len(rare) :]
    last, k = tokens[order], k[order]
    need -= len(rare)
    own = int(math.log(n) / BAND)
    for band in {own, own - 1}:
        groups = _groups(band)
        group = (mixed(last) % np.uint64(groups)).astype(np.int64) + (k - 2) * groups
        # the k-1 first tokens of a group add nothing
        by_group = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[by_group], prepend=-1))
        rank = np.empty(len(last), dtype=np.int64)
        rank[by_group] = np.arange(len(last)) - np.repeat(starts, np.diff(starts, append=len(last)))
        spent = np.cumsum(rank >= k - 1)
        by_group = by_group[by_group <= np.searchsorted(spent, need)]
        for sig, where in _combinations(last[by_group], group[by_group], k[by_group], band):
            sigs.append(sig)
            sizes.append(_partner(n, n - len(rare) - spent[by_group[where]] + 1))
    sig, first = np.unique(np.concatenate(sigs), return_index=True)
    return sig, np.concatenate(sizes)[first]


def _combinations(token, group, k, band):
    """Hashes of the pairs and triples of tokens of one group, and where their last tokens
    are; rows are ordered by group."""
    import numpy as np

    from .shingles import mixed

    out, n = [], len(token)
    for gap in range(1, n):
        at = np.flatnonzero(group[gap:] == group[:-gap])
        if not len(at):
            break
        pair = mixed(token[at] * np.uint64(3) + mixed(token[at + gap] + np.uint64(band)))
        out.append((pair[k[at] == 2], at[k[at] == 2] + gap))
        at, pair = at[k[at] == 3], pair[k[at] == 3]
        for third in range(gap + 1, n):
            inside = at + third < n
            at, pair = at[inside], pair[inside]
            same = group[at + third] == group[at]
            if not same.any():
                break
            out.append((mixed(pair[same] * np.uint64(5) + mixed(token[at[same] + third])), at[same] + third))
    return out


def set_ids(tokens) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    import numpy as np

    from .shingles import mixed

    total = np.array([len(tokens)], dtype=np.uint64) + tokens.sum(dtype=np.uint64)
    folds = [np.bitwise_xor.reduce(mixed(tokens ^ np.uint64(salt)), initial=np.uint64(0), keepdims=True) for salt in (0xA5A5A5A5A5A5A5A5, 0x3C3C3C3C3C3C3C3C)]
    key, check = (int(mixed(total ^ mixed(x))[0].astype(np.int64)) for x in folds)
    return key, check


def sketch(tokens):
    """Parities, in a power of two of 64-bit numbers: each token turns over one bit.  The bits
    in which two sketches of one length differ are at most the tokens that only one of the
    sets has; a sketch folds to half its length by exclusive or of its halves."""
    import numpy as np

    from .shingles import mixed

    bits = 64 * max(SKETCH, 1 << max(0, (len(tokens) - 1) // 32).bit_length())
    bit = (mixed(tokens) >> np.uint64(32)) % np.uint64(bits)
    odd = (np.bincount(bit.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def text_digest(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts.  Rows of kind 0 are documents: ``id``, text digest
    ``doc``, set size ``n``, set digests ``key`` and ``check``, and ``sketch``.  Rows of
    kind 1 are tokens that several sets of one input batch hold: ``key``, and their number
    ``n``; a token of more sets than there are batches is bound to be among them."""
    kind, names = docs.schema[id_col].dataType.simpleString(), ["kind", "id", "doc", "n", "key", "check", "sketch"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .shingles import sets

        for batch in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            found = sets(batch.column(1).to_pylist())
            n = len(found)
            ids = np.array([set_ids(s) for s in found], dtype=np.int64).reshape(n, 2)
            once = np.unique(ids[:, 0], return_index=True)[1]
            token, times = np.unique(np.concatenate([found[i] for i in once] or [np.empty(0, dtype=np.uint64)]), return_counts=True)
            token, times = token[times > 1], times[times > 1]
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), batch.column(0), batch.column(2), pa.array([len(s) for s in found], pa.int64()), pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array([sketch(s) for s in found], pa.list_(pa.int64()))], names)
            m = len(token)
            yield pa.RecordBatch.from_arrays([pa.array([1] * m, pa.int32()), pa.nulls(m, batch.column(0).type), pa.nulls(m, pa.int64()), pa.array(times, pa.int64()), pa.array(token.view(np.int64)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int64()))], names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), text_digest(text_col).alias("doc")).mapInArrow(run, f"kind int, id {kind}, doc long, n long, key long, check long, sketch array<long>")


def index_rows(docs: DataFrame, known, text_col: str) -> DataFrame:
    """``(sig, node, n, most, score, parent, members)``: a class under each of its
    signatures, the greatest size ``most`` of its partners there, and a ``score``, the
    lower the more partners it may have.  Where more than HOT_BATCH classes of one input
    batch share a signature, only the first by score stands for them with ``members``, and
    the others have it as ``parent``.  ``known`` broadcasts the frequent tokens, their
    levels, and set digests that several sets have: these go by their second digest."""
    names = ["sig", "node", "n", "most", "score", "parent", "members"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from .shingles import sets

        frequent, level, clash = known.value
        for batch in (part for whole in batches for part in slices(whole, 0, SLICE_BYTES)):
            out, done = [], set()
            for s in sets(batch.column(0).to_pylist()):
                key, check = set_ids(s)
                key = check if key in clash else key
                if key in done:
                    continue
                done.add(key)
                x, most = signatures(s, frequent, level)
                rows = np.empty((4, len(x)), dtype=np.int64)
                rows[0], rows[1], rows[2], rows[3] = x.view(np.int64), key, len(s), most
                out.append(rows)
            if not out:
                continue
            sig, node, size, most = np.concatenate(out, axis=1)
            del out
            score = -(1000 * most) // np.maximum(size, 1)
            order = np.lexsort((node, score, sig))
            sig, node, size, most, score = (c[order] for c in (sig, node, size, most, score))
            head = np.flatnonzero(np.diff(sig, prepend=sig[:1] - 1)) if len(sig) else np.empty(0, dtype=np.int64)
            counts = np.diff(head, append=len(sig))
            hot = np.repeat(counts > HOT_BATCH, counts)
            members = np.where(hot, 0, 1)
            members[head] = np.where(counts > HOT_BATCH, counts, 1)
            parent = pa.array(np.repeat(node[head], counts), mask=members > 0)
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node), *(pa.array(c.astype(np.int32)) for c in (size, most, score)), parent, pa.array(members.astype(np.int32))], names)

    return docs.select(F.col(text_col).alias("t")).mapInArrow(run, "sig long, node long, n int, most int, score int, parent long, members int")


def buckets(index: DataFrame) -> DataFrame:
    """``(sig, node, n, most, score, head, partners, large)`` of the rows that meet others:
    in small buckets ``partners`` are the earlier members that may be alike, in large ones
    ``head`` is the first member."""
    # a row that isn't its batch's first for a signature goes to a partition of its own
    index = index.withColumn("apart", F.when(F.col("members") > 0, F.lit(0)).otherwise(F.col("node")))
    bucket = Window.partitionBy("sig", "apart").orderBy("score", "node")
    whole = bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = [F.lag(F.struct("node", "n", "most"), i).over(bucket).alias(f"e{i}") for i in range(1, SMALL)]
    about = [F.sum("members").over(whole).alias("total"), F.first("node").over(whole).alias("first"), F.min("node").over(whole).alias("lo"), F.max("node").over(whole).alias("hi")]
    rows = index.select("*", *about, *earlier).where("members <> 1 OR lo <> hi")
    large = (F.col("members") == 0) | (F.col("total") > SMALL)  # copies in several batches count anew
    fits = F.filter(F.array(*(f"e{i}" for i in range(1, SMALL))), lambda p: p.isNotNull() & (p["n"] <= F.col("most")) & (F.col("n") <= p["most"]) & (p["node"] != F.col("node")))
    partners = F.when(~large, F.transform(fits, lambda p: p["node"]))
    return rows.select("sig", "node", "n", "most", "score", F.coalesce("parent", "first").alias("head"), partners.alias("partners"), large.alias("large")).where("large OR size(partners) > 0")


def near(na: str, sa: str, nb: str, sb: str):
    """Whether two sets may be alike by the columns of their sizes and sketches."""
    half = lambda x: let(F.size(x) / 2, lambda h: F.zip_with(F.slice(x, 1, h.cast("int")), F.slice(x, h.cast("int") + 1, h.cast("int")), lambda p, q: p.bitwiseXOR(q)))
    short = lambda x, y: F.when(F.size(x) > F.size(y), half(x)).otherwise(x)
    # sketches still of unequal length belong to sizes too far apart: the sum is null, the pair goes
    apart = F.aggregate(F.zip_with(short(F.col(sa), F.col(sb)), short(F.col(sb), F.col(sa)), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return (100 + PERCENT) * F.greatest(apart, F.abs(F.col(na) - F.col(nb))) <= (100 - PERCENT) * (F.col(na) + F.col(nb))


def possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that sizes and sketches don't rule out.  Sets of which one
    has ``d`` tokens that the other lacks, both ways counted, are alike only if
    (100 + t) * d <= (100 - t) * (sum of their sizes), with t in percent."""
    left, right = sketches.toDF("a", "na", "sa"), sketches.toDF("b", "nb", "sb")
    return pairs.join(left, "a").join(right, "b").where(near("na", "sa", "nb", "sb")).select("a", "b")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets are alike; ``texts(node, t)`` has their texts."""

    def run(batches):
        from functools import lru_cache

        import pyarrow as pa

        from .shingles import common, sets

        one = lru_cache(maxsize=32)(lambda t: sets([t])[0])
        for batch in batches:
            alike = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = one(x.as_py()), one(y.as_py())
                both = common(x, y)
                alike.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            keep = pa.array(alike, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], ["a", "b"])

    left = texts.toDF("a", "ta")
    right = texts.toDF("b", "tb")
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``docs``: the set size, and the
    least id that links reach, the row's own included.

    A null text, an empty one, or one without words has no shingles and links with
    nothing; texts of any length are hashed whole, in slices of a batch; repeated rows
    stay, as rows of one class; rows of one id and different texts are compared each by
    its text; a component in which all ids are null has a null id.  Further columns are
    not read, and an empty table gives an empty result."""
    out = grouped(docs, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))


def _frequent(scanned: DataFrame, n_docs: int):
    """The sorted frequent tokens and the number of them in a combination: at most
    MAX_FREQUENT, whatever the input.  They decide the order of tokens, never a link."""
    import numpy as np

    counts = stored(scanned.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")), "tokens")
    least = max(FREQUENT, int(FREQUENT_SHARE * n_docs))
    while counts.where(F.col("n") > least).count() > MAX_FREQUENT:
        least *= 2
    very = max(VERY_FREQUENT, int(VERY_FREQUENT_SHARE * n_docs))
    found = counts.where(F.col("n") > least).select("key", (F.col("n") > very).alias("very")).toPandas()
    removed(counts)
    token = found["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], np.where(found["very"].to_numpy(dtype=bool), 3, 2)[order].astype(np.int8)


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, doc, n, root, component)`` per row of ``docs``: text digest, set size, the
    least class of the row's component and its least id; without shingles both are null."""
    spark = docs.sparkSession
    scanned = stored(scan(docs, id_col, text_col), "scan")
    rows = scanned.where("kind = 0").select("id", "doc", "n", "key", "check", "sketch")
    # digests of two sets: some n * n / 2**65 of n sets
    clash = [r.key for r in rows.where("n > 0").groupBy("key").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo <> hi").select("key").collect()]
    if clash:
        rows = rows.withColumn("key", F.when(F.col("key").isin(clash), F.col("check")).otherwise(F.col("key")))
    known = spark.sparkContext.broadcast((*_frequent(scanned, rows.count()), set(clash)))
    # of each class the row with the least id, nulls last, then the least text digest
    least_row = F.min(F.struct(F.col("id").isNull(), "id", "doc")).alias("row")
    classes = rows.where("n > 0").groupBy("key").agg(least_row).select("key", F.col("row.id").alias("first"), F.col("row.doc").alias("first_doc"))

    met = stored(buckets(index_rows(docs, known, text_col)), "buckets")
    small = met.where("NOT large").select("node", F.explode("partners").alias("other"))
    large = met.where("large").select("sig", "node", "n", "most", "score", "head")
    pairs = small.union(large.where("head <> node").select("node", "head")).toDF("x", "y")
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()

    nodes = met.select("node").union(met.where("NOT large").select(F.explode("partners"))).distinct()
    firsts = nodes.join(classes, F.col("node") == F.col("key")).select("node", "first", "first_doc")
    own = (F.col("id").eqNullSafe(F.col("first"))) & (F.col("doc") == F.col("first_doc")) & (F.col("node") == F.col("key"))
    sketches = stored(rows.join(firsts, own).groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("first").alias("first"), F.first("first_doc").alias("first_doc")), "sketches")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), text_digest(text_col).alias("doc"))

    def alike(left):
        nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = stored(sketches.select("node", "first", "first_doc").join(nodes, "node", "left_semi"), "nodes")
        n = nodes.count()
        few = F.broadcast(nodes) if n <= BROADCAST_ROWS else nodes
        texts = stored(source.join(few, F.col("id").eqNullSafe(F.col("first")) & (F.col("doc") == F.col("first_doc"))).select("node", "t"), "texts")
        once = texts.dropDuplicates(["node"]) if texts.count() > n else texts  # repeated rows
        links = stored(verified(left, once), "links")
        removed(nodes, texts)
        return links

    left = stored(possible(pairs, sketches.select("node", "n", "sketch")), "pairs")
    # one pair of each class first; most of the others are then of one component
    links = alike(left.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    roots = components(links)
    apart = lambda x: x.join(roots.toDF("a", "ra"), "a", "left").join(roots.toDF("b", "rb"), "b", "left").where("ra IS NULL OR rb IS NULL OR ra <> rb").select("a", "b")
    more = alike(apart(left).join(links, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        links, roots = links.unionByName(more), components(links.unionByName(more))

    def tested(met_again, tried):
        """Links of the pairs that haven't been tried, and these pairs."""
        new = stored(met_again.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "new")
        may = stored(possible(new, sketches.select("node", "n", "sketch")), "pairs")
        return (None if may.isEmpty() else alike(may)), new

    tried, turn = left, 0
    open_ = stored(_open(large, roots), "open")
    while turn < STAR_ROUNDS and not open_.isEmpty():
        # one member of each component, another in each bucket and round, meets one of the first
        best = F.col("score") if turn == 0 else F.xxhash64("node", "sig", F.lit(turn))
        heads = open_.groupBy("sig", "root").agg(F.min(F.struct(best.alias("order"), "node", "n", "most")).alias("h"))
        centre = heads.groupBy("sig").agg(F.min("h").alias("c"))
        star = heads.join(centre, "sig").where("h.node <> c.node AND h.n <= c.most AND c.n <= h.most").select(F.col("h.node").alias("x"), F.col("c.node").alias("y"))
        more, new = tested(star, tried)
        tried, turn = tried.unionByName(new), turn + 1
        if more is None or more.isEmpty():
            break
        links = links.unionByName(more)
        roots = components(links)
        open_ = stored(_open(large, roots), "open")
    if not open_.isEmpty():
        # of what is left, the pairs that sketches don't rule out as they meet
        sketched = open_.join(sketches.select("node", "sketch"), "node").select("sig", "node", "n", "most", "root", "sketch")
        other = sketched.toDF("sig", "y", "n2", "most2", "root2", "sketch2")
        fits = "node < y AND root <> root2 AND n <= most2 AND n2 <= most"
        rest = sketched.join(other, "sig").where(F.expr(fits) & near("n", "sketch", "n2", "sketch2")).select(F.col("node").alias("x"), "y")
        more, _ = tested(rest, tried)
        if more is not None and not more.isEmpty():
            roots = components(links.unionByName(more))

    labelled = classes.join(roots, classes["key"] == roots["node"], "left").select("key", "first", F.coalesce("root", "key").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component"))
    by_class = stored(labelled.join(smallest, "root").select(F.col("key").alias("k"), "root", "component"), "labels")
    removed(met, sketches, left)
    out = rows.join(by_class, (rows["key"] == F.col("k")) & (rows["n"] > 0), "left")
    return out.select("id", "doc", "n", "root", "component")


def _open(large: DataFrame, roots: DataFrame) -> DataFrame:
    """``(sig, node, n, most, score, root)`` of the members of large buckets that span several
    components and hold some partner for them by size."""
    member = large.select("sig", "node", "n", "most", "score").join(roots, "node", "left").select("sig", "node", "n", "most", "score", F.coalesce("root", "node").alias("root"))
    span = member.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("low"), F.max("most").alias("high")).where("lo <> hi").select("sig", "low", "high")
    return member.join(span, "sig").where("low <= most AND n <= high").select("sig", "node", "n", "most", "score", "root").distinct()
