"""How often the tokens of two tokenizers cover the same text: counts of linked id pairs.

Both token streams of a text cover the same bytes.  Offsets where tokens of both end cut
them into groups, and every token of one side is linked with every token of the other in
its group.  The count of an id pair is the number of documents that hold it linked.

1. First pass: every text is encoded and aligned.  What is kept is the token ids of each
   document and, for some megabytes of text at a time, the distinct pairs with their
   number of documents.
2. The distinct pairs of the corpus are dealt to buckets by hash, and each bucket gets a
   minimal perfect hash in a task of its own (hash and displace: keys in small lots, the
   largest lots first, each with the first displacement that puts all its keys on free
   slots).  So every pair has one slot, and slots have no gaps.
3. Each task adds the counts of its rows into dense vectors, one for each bucket, indexed by
   slot; vectors are summed as a tree, in two levels.
4. Second pass: documents are aligned anew from their ids, and each pair is looked up by
   its slot, where its key is verified.

The hash with its keys and counts is broadcast when there are at most MAX_PAIRS pairs.
There can't be more than the product of the vocabularies, but that is too large a bound for
a broadcast, so beyond MAX_PAIRS counts and look-ups are a grouping and a join on pairs.

Texts are encoded in units: a space between two signs or letters always begins a token of
either tokenizer, so a unit ends before it, and groups never cross its edges.  A unit that
occurs again is taken from a bounded table of each Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import removed, slices, stored

#: Pairs whose hash, keys and counts are broadcast (some 20 bytes each).
MAX_PAIRS = 1 << 22
#: Pairs of a bucket on average, and of a lot within it.
BUCKET_PAIRS, LOT_PAIRS = 1 << 16, 4
#: Displacements that are tried at once.
TRIES = 64
#: Text bytes that are aligned together, distinct pairs that a task holds before it gives
#: them on, units that a worker remembers, and links of one group made at once.
SLICE_BYTES, HELD_PAIRS, UNITS, LINKS = 2 << 20, 1 << 19, 1 << 17, 1 << 20
#: Characters of new units that are encoded in one call.
CHUNK_CHARS = 1 << 14
_CUT = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")
_PLAIN = re.compile(r" [!-~\w](?:.*[!-~\w])?", re.DOTALL)
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others in order from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pair:
    """Two tokenizers in a Python worker, and the ids of units met before."""

    def __init__(self, json_path: str, model_path: str):
        import os

        import numpy as np
        from sentencepiece import SentencePieceProcessor

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(json_path)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_file=model_path)
        letters = byte_letters()
        with open(json_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece goes on behind a space: units can't be encoded apart")
        self.b_bytes = [bytes([int(m[1], 16)]) if self.second.is_byte(i) and (m := _BYTE.fullmatch(p)) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        self.decimal = {end: [f"{i}{end}" for i in range(max(len(self.a_bytes), len(self.b_bytes)))] for end in ",|;"}
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.bad: set[str] = set()

    def _encode(self, texts: list[str]):
        """Ids of both for texts that begin with a space."""
        ones = self.first.encode_batch(texts, add_special_tokens=False)
        return zip(texts, (x.ids for x in ones), self.second.encode([t[1:] for t in texts], num_threads=1), strict=True)

    def _same(self, text: str, a: list[int], b: list[int]) -> bool:
        raw = text.encode("utf-8", "surrogatepass")
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw

    def _learn(self, units: list[str]) -> None:
        import numpy as np

        if len(self.known) > UNITS:
            self.known.clear()
            self.bad.clear()
        new = [u for u in dict.fromkeys(units) if u not in self.known]
        plain, alone, chunk, size = [], [], [], 0
        for u in new:
            if len(u) < CHUNK_CHARS and _PLAIN.fullmatch(u):
                chunk.append(u)
                size += len(u)
                if size >= CHUNK_CHARS:
                    plain.append(chunk)
                    chunk, size = [], 0
            else:
                alone.append(u)
        plain.append(chunk)
        plain = [c for c in plain if c]
        for chunk, (text, a, b) in zip(plain, self._encode(["".join(c) for c in plain]), strict=True):
            if not self._same(text, a, b):
                alone += chunk
                continue
            ends = np.cumsum([len(u.encode()) for u in chunk])
            cuts = []
            for ids, sizes in ((a, self.a_sizes), (b, self.b_sizes)):
                ids = np.array(ids, dtype="<u2")
                at = np.searchsorted(np.cumsum(sizes[ids]), ends) + 1
                cuts.append((ids.tobytes(), (2 * at).tolist()))
            (pa, at_a), (pb, at_b) = cuts
            la = lb = 0
            for u, x, y in zip(chunk, at_a, at_b, strict=True):
                self.known[u] = (pa[la:x], pb[lb:y])
                la, lb = x, y
        for u in alone:  # one at a time: these may be long
            for text, a, b in self._encode([u]):
                self.known[u] = (np.array(a, dtype="<u2").tobytes(), np.array(b, dtype="<u2").tobytes())
                if not self._same(text, a, b):
                    self.bad.add(u)

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Packed 16-bit ids of both tokenizers for each text; none for null and empty texts
        and for texts that either doesn't give back byte by byte."""
        cut = [_CUT.split(" " + t) if t else [] for t in texts]
        self._learn([u for units in cut for u in units])
        out = []
        for t, units in zip(texts, cut, strict=True):
            both = [self.known[u] for u in units]
            a, b = b"".join([x[0] for x in both]), b"".join([x[1] for x in both])
            if self.bad and not self.bad.isdisjoint(units) and not self._same(" " + t, unpacked(a).tolist(), unpacked(b).tolist()):
                a = b = b""
            out.append((a, b))
        return out


@lru_cache(maxsize=2)
def tokenizers_of(json_path: str, model_path: str) -> Pair:
    return Pair(json_path, model_path)


def unpacked(ids: bytes | None):
    import numpy as np

    return np.frombuffer(ids or b"", dtype="<u2").astype(np.int64)


class Aligned:
    """The groups of several documents at once.  ``doc`` holds the place of each group's
    document; the groups' tokens follow each other in ``a`` and ``b``."""

    def __init__(self, tokenizers: Pair, packed: list[tuple[bytes, bytes]]):
        import numpy as np

        self.n_a, self.n_b = (np.array([len(x[k]) // 2 for x in packed], dtype=np.int64) for k in (0, 1))
        self.a, self.b = (unpacked(b"".join(x[k] for x in packed)) for k in (0, 1))
        ends_a, ends_b = np.cumsum(tokenizers.a_sizes[self.a]), np.cumsum(tokenizers.b_sizes[self.b])
        mark = np.zeros(int(ends_a[-1]) + 1 if len(ends_a) else 1, dtype=bool)
        mark[ends_b] = True
        hit_a = mark[ends_a]
        mark[:] = False
        mark[ends_a[hit_a]] = True
        hit_b = mark[ends_b]
        self.group_a, self.group_b = np.cumsum(hit_a) - hit_a, np.cumsum(hit_b) - hit_b
        self.hit_a, self.hit_b = hit_a, hit_b
        n = int(hit_a.sum())
        self.m, self.k = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        self.doc = np.repeat(np.arange(len(packed)), self.n_a)[hit_a]

    def links(self, vocab_b: int):
        """Parts ``(doc, pair, times)`` of all links: pairs are numbers, and equal links of a
        very large group come once with their number of times."""
        import numpy as np

        size = self.m * self.k
        first_b = np.cumsum(self.k) - self.k
        rows = np.flatnonzero(size[self.group_a] <= LINKS)
        reach = self.k[self.group_a[rows]]
        total = np.cumsum(reach)
        start = 0
        while start < len(rows):
            stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + LINKS, side="right")))
            at, n = rows[start:stop], reach[start:stop]
            group = np.repeat(self.group_a[at], n)
            other = first_b[group] + np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
            yield self.doc[group], np.repeat(self.a[at], n) * vocab_b + self.b[other], np.ones(len(group), dtype=np.int64)
            start = stop
        for g in np.flatnonzero(size > LINKS):
            (x, nx), (y, ny) = np.unique(self.a[self.group_a == g], return_counts=True), np.unique(self.b[self.group_b == g], return_counts=True)
            step = max(1, LINKS // len(y))
            for i in range(0, len(x), step):
                pair = (x[i : i + step, None] * vocab_b + y[None, :]).ravel()
                yield np.full(len(pair), self.doc[g]), pair, (nx[i : i + step, None] * ny[None, :]).ravel()

    def texts(self, decimal) -> list[str]:
        """``a1,a2|b1;a3|b2`` of each document."""
        import numpy as np

        n = len(decimal[","])
        table = decimal[","] + decimal["|"] + decimal[";"]
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[np.arange(len(self.a)) + (np.cumsum(self.k) - self.k)[self.group_a]] = self.a + n * self.hit_a
        code[np.arange(len(self.b)) + np.cumsum(self.m)[self.group_b]] = self.b + 2 * n * self.hit_b
        out, start = [], 0
        for size in (self.n_a + self.n_b).tolist():
            out.append("".join(map(table.__getitem__, code[start : start + size].tolist()))[:-1])
            start += size
        return out


def _merged(parts):
    """Distinct numbers, ascending, and the sums of their counts, of parts ``(numbers, counts)``."""
    import numpy as np

    empty = np.empty(0, dtype=np.int64)
    number, count = (np.concatenate([empty, *(p[k] for p in parts)]) for k in (0, 1))
    order = np.argsort(number, kind="stable")
    number, count = number[order], count[order]
    head = np.flatnonzero(np.diff(number, prepend=-1))
    return number[head], np.add.reduceat(count, head) if len(head) else count


def _by_document(aligned: Aligned, vocab_b: int):
    """``(documents, pairs, times)``: each distinct pair of each document and its links."""
    parts, held = [], 0
    for doc, pair, times in aligned.links(vocab_b):
        parts.append(((doc << 32) + pair, times))
        held += len(pair)
        if held > 4 * LINKS:
            parts = [_merged(parts)]
            held = 0
    code, times = _merged(parts)
    return code >> 32, code & ((1 << 32) - 1), times


def scan(docs: DataFrame, json_path: str, model_path: str, id_col: str, text_col: str) -> DataFrame:
    """The first pass.  Rows of kind 0 are documents, ``id, row, a, b``, with a number that no
    other row has and packed ids; rows of kind 1 are distinct ``pairs`` with the number of
    documents in ``counts``, of the texts that one task met between two such rows."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["kind", "id", "row", "a", "b", "pairs", "counts"]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        tok, longs = tokenizers_of(json_path, model_path), pa.list_(pa.int64())
        row, held, id_type = TaskContext.get().partitionId() << 36, _merged([]), pa.int64()

        def counted():
            return pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), *(pa.array([x], longs) for x in held)], names)

        for part in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            n, id_type = part.num_rows, part.column(0).type
            packed = tok.encode(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([0] * n, pa.int32()), part.column(0), pa.array(np.arange(row, row + n)), *(pa.array([x[k] for x in packed], pa.binary()) for k in (0, 1)), pa.nulls(n, longs), pa.nulls(n, longs)], names)
            row += n
            _, pair, _ = _by_document(Aligned(tok, packed), len(tok.b_bytes))
            held = _merged([held, (pair, np.ones(len(pair), dtype=np.int64))])
            if len(held[0]) > HELD_PAIRS:
                yield counted()
                held = _merged([])
        if len(held[0]):
            yield counted()

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, f"kind int, id {kind}, row long, a binary, b binary, pairs array<long>, counts array<long>")


def _hashed(pair, salt: int):
    """Hashes of pairs, other ones for each salt."""
    import numpy as np

    from .shingles import mixed

    return mixed(pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def _slots(pair, displacement, n: int):
    """The slots of pairs under their lots' displacements: from 0 on a displacement is a
    salt, below it is the slot of a lot's only key."""
    import numpy as np

    from .shingles import mixed

    moved = mixed(_hashed(pair, 2) ^ (displacement.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return np.where(displacement < 0, -1 - displacement, (moved % np.uint64(max(n, 1))).astype(np.int64))


def bucket_of(pair, buckets: int):
    import numpy as np

    return (_hashed(pair, 0) % np.uint64(buckets)).astype(np.int64)


def _lots(n: int) -> int:
    return n // LOT_PAIRS + 1


def perfect_hash(pairs):
    """``(keys by slot, displacements of the lots)`` of distinct pairs: a bijection on 0..n-1."""
    import numpy as np

    n = len(pairs)
    lot = (_hashed(pairs, 1) % np.uint64(_lots(n))).astype(np.int64)
    by_lot = np.argsort(lot, kind="stable")
    sizes = np.bincount(lot, minlength=_lots(n))
    starts = np.cumsum(sizes) - sizes
    displacement, free, keys = np.zeros(len(sizes), dtype=np.int64), np.ones(n, dtype=bool), np.empty(n, dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    many = order[sizes[order] > 1]
    for j in many.tolist():
        key = pairs[by_lot[starts[j] : starts[j] + sizes[j]]]
        first = 0
        while True:
            tries = np.arange(first, first + TRIES)
            slot = _slots(key[None, :], tries[:, None], n)
            ok = free[slot].all(axis=1)
            if ok.any():  # keys of one lot must not meet each other either
                apart = np.sort(slot[ok], axis=1)
                ok[ok] = (np.diff(apart, axis=1) > 0).all(axis=1)
                if ok.any():
                    break
            first += TRIES
        best = int(np.argmax(ok))
        displacement[j], free[slot[best]], keys[slot[best]] = tries[best], False, key
    single = order[sizes[order] == 1]
    left = np.flatnonzero(free)
    displacement[single], keys[left] = -1 - left, pairs[by_lot[starts[single]]]
    return keys, displacement


class Index:
    """The perfect hash of all buckets, with the keys that verify it and, once they are known,
    the counts and whether a count is its first id's highest."""

    def __init__(self, rows):
        import numpy as np

        rows = sorted(rows, key=lambda r: r[0])
        self.buckets = max([r[0] for r in rows], default=0) + 1
        n, lots = np.zeros(self.buckets, dtype=np.int64), np.zeros(self.buckets, dtype=np.int64)
        for bucket, keys, displacement in rows:
            n[bucket], lots[bucket] = len(keys) // 8, len(displacement) // 4
        self.n, self.lots = n, lots
        self.first, self.first_lot = np.cumsum(n) - n, np.cumsum(lots) - lots
        self.keys = np.frombuffer(b"".join(r[1] for r in rows), dtype="<i8")
        self.displacement = np.frombuffer(b"".join(r[2] for r in rows), dtype="<i4")

    def slots(self, pair, buckets: int):
        """Where pairs are; a pair that the hash wasn't made of is an error."""
        import numpy as np

        from .shingles import mixed

        bucket = bucket_of(pair, buckets)
        lot = (_hashed(pair, 1) % self.lots[bucket].astype(np.uint64)).astype(np.int64)
        displacement = self.displacement[self.first_lot[bucket] + lot].astype(np.int64)
        moved = mixed(_hashed(pair, 2) ^ (displacement.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        slot = self.first[bucket] + np.where(displacement < 0, -1 - displacement, (moved % self.n[bucket].astype(np.uint64)).astype(np.int64))
        if (self.keys[slot] != pair).any():
            raise KeyError("a pair that no document of the first pass holds")
        return slot


def build(distinct: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, keys, displacement)``: the perfect hash of each bucket of ``distinct(pair)``.
    Buckets are about equal, as they are dealt by a hash of distinct pairs."""

    def dealt(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            pair = np.asarray(batch.column(0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(pair, buckets)), batch.column(0)], ["bucket", "pair"])

    def run(table):
        import numpy as np
        import pyarrow as pa

        keys, displacement = perfect_hash(np.asarray(table.column("pair"), dtype=np.int64))
        return pa.table({"bucket": table.column("bucket")[:1], "keys": pa.array([keys.astype("<i8").tobytes()], pa.binary()), "displacement": pa.array([displacement.astype("<i4").tobytes()], pa.binary())})

    return distinct.mapInArrow(dealt, "bucket long, pair long").groupBy("bucket").applyInArrow(run, "bucket long, keys binary, displacement binary")


def dense_counts(counted: DataFrame, index, buckets: int) -> DataFrame:
    """``(bucket, vector)``: the counts of a bucket's pairs by slot.  A task holds a vector for
    each bucket that its rows touch; the vectors of some tasks are summed first, then those sums."""
    width = max(1, int(counted.rdd.getNumPartitions() ** 0.5))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        found, vectors = index.value, {}
        for batch in batches:
            for pairs, counts in zip(batch.column(0), batch.column(1), strict=True):
                pair, count = np.asarray(pairs.values, dtype=np.int64), np.asarray(counts.values, dtype=np.int64)
                slot = found.slots(pair, buckets)
                bucket = np.searchsorted(found.first + found.n, slot, side="right")
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                for at in np.split(order, cuts):
                    j = int(bucket[at[0]])
                    if j not in vectors:
                        vectors[j] = np.zeros(found.n[j], dtype="<i8")
                    vectors[j][slot[at] - found.first[j]] += count[at]
        salt = TaskContext.get().partitionId() % width
        for j, v in vectors.items():
            yield pa.RecordBatch.from_arrays([pa.array([j], pa.int64()), pa.array([salt], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["bucket", "salt", "vector"])

    def added(table):
        import numpy as np
        import pyarrow as pa

        total = 0
        for v in table.column("vector"):
            total = total + np.frombuffer(v.as_py(), dtype="<i8")
        return pa.table({"bucket": table.column("bucket")[:1], "vector": pa.array([total.tobytes()], pa.binary())})

    some = counted.select("pairs", "counts").mapInArrow(run, "bucket long, salt int, vector binary").groupBy("bucket", "salt").applyInArrow(added, "bucket long, vector binary")
    return some.groupBy("bucket").applyInArrow(added, "bucket long, vector binary")


OUT = "n_a long, n_b long, n_groups long, n_links long"


def second_pass(documents: DataFrame, json_path: str, model_path: str, index=None, buckets: int = 1) -> DataFrame:
    """Documents aligned anew, with their figures.  With ``index`` (hash, counts, highest) each
    pair is looked up and ``n_best, count_sum`` are added; else the distinct ``pairs`` of each
    document and their ``times``."""
    kind = documents.schema["id"].dataType.simpleString()
    more = "n_best long, count_sum long" if index else "pairs array<long>, times array<long>"
    names = ["id", "row", *(c.split()[0] for c in OUT.split(", ")), "groups", *(c.split()[0] for c in more.split(", "))]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tok = tokenizers_of(json_path, model_path)
        for part in (part for whole in batches for part in slices(whole, 2, SLICE_BYTES)):
            n = part.num_rows
            aligned = Aligned(tok, list(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)))
            total = lambda at, x: np.bincount(at, weights=x, minlength=n).astype(np.int64)
            groups, links = np.bincount(aligned.doc, minlength=n), total(aligned.doc, aligned.m * aligned.k)
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligned.texts(tok.decimal)]
            doc, pair, times = _by_document(aligned, len(tok.b_bytes))
            if index:
                found, counts, best = index.value
                slot = found.slots(pair, buckets)
                last = [pa.array(total(doc, times * best[slot])), pa.array(total(doc, times * counts[slot]))]
            else:
                cuts = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                last = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (pair, times)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(x) for x in (aligned.n_a, aligned.n_b, groups, links)), pa.array(digests), *last], names)

    return documents.select("id", "row", "a", "b").mapInArrow(run, f"id {kind}, row long, {OUT}, groups string, {more}")


def align(docs: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row of
    ``docs``: tokens of both, groups, links, links whose count is the highest of their first
    id, the sum of counts over links, and the digest of the groups' ids.

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte,
    have no tokens: zeros and an empty digest.  A text's tokens must fit a task; a group of
    very many links is counted by its distinct ids.  Repeated rows stay and each counts as a
    document; of equal highest counts all are highest; null ids stay; further columns are not
    read; an empty table gives an empty result."""
    import numpy as np

    spark = docs.sparkSession
    scanned = stored(scan(docs, json_path, model_path, id_col, text_col), "aligned")
    documents, counted = scanned.where("kind = 0"), scanned.where("kind = 1")
    distinct = stored(counted.select(F.explode("pairs").alias("pair")).distinct(), "pairs")
    n = distinct.count()
    if n > MAX_PAIRS:
        out = _joined(second_pass(documents, json_path, model_path), counted, json_path, model_path)
    else:
        buckets = n // BUCKET_PAIRS + 1
        found = Index([tuple(r) for r in build(distinct, buckets).collect()])  # at most MAX_PAIRS keys
        counts = np.zeros(n, dtype=np.int64)
        for r in dense_counts(counted, spark.sparkContext.broadcast(found), buckets).collect():
            counts[found.first[r.bucket] :][: found.n[r.bucket]] = np.frombuffer(r.vector, dtype="<i8")
        a = found.keys // len(tokenizers_of(json_path, model_path).b_bytes)
        most = np.zeros(int(a.max(initial=0)) + 1, dtype=np.int64)
        np.maximum.at(most, a, counts)
        out = second_pass(documents, json_path, model_path, spark.sparkContext.broadcast((found, counts, counts == most[a])), buckets)
    removed(distinct)
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def _joined(second: DataFrame, counted: DataFrame, json_path: str, model_path: str) -> DataFrame:
    """The way beyond MAX_PAIRS: counts by grouping, look-ups by a join in which a pair that
    very many documents hold is spread by a salt."""
    salts, vocab_b = 64, len(tokenizers_of(json_path, model_path).b_bytes)
    entries = counted.select(F.explode(F.arrays_zip("pairs", "counts")).alias("e")).groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.counts").alias("count"))
    entries = entries.withColumn("first_id", F.expr(f"pair div {vocab_b}"))
    most = entries.groupBy("first_id").agg(F.max("count").alias("most"))
    known = stored(entries.join(most, "first_id").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best")), "counts")
    second = stored(second, "second")
    # only pairs of more documents than there are salts are spread
    spread = known.withColumn("salt", F.explode(F.when(F.col("count") > salts, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(-1)))))
    held = second.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("e")).select("row", F.col("e.pairs").alias("pair"), F.col("e.times").alias("times"))
    both = F.explode(F.array(F.lit(-1), (F.col("row") % salts).cast("int"))).alias("salt")
    met = held.select("row", "pair", "times", both).join(spread, ["pair", "salt"])
    sums = met.groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return second.join(sums, "row", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
