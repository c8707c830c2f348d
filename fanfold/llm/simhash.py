"""SimHash near duplicates by meet-in-the-middle ball hashing.

A fingerprint is the majority, bit by bit, of the hashes of a text's word shingles.  Two
fingerprints link when they differ in at most RADIUS bits.  Every distinct fingerprint is
sent to each of the 65 numbers within half that radius (itself and its 64 one-bit
variants); two that link share such a number half way, and any two that share one link.

A variant gathers no rows: what reaches it is one bit for each fingerprint, the bit that
was turned over, so a bitwise OR, combined before the shuffle, names all that met there.
That is 65 fingerprints at most, whatever the corpus.  Each is linked with the least of
them, which joins the same components as all pairs would; the links of all variants are
deduplicated and verified.  Copies are one fingerprint and never meet in pairs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import let, removed, slices, stored
from .components import components

SHINGLE, SEED = 3, 42
#: Bits in which linked fingerprints may differ; variants are made within half of it.
RADIUS = 2
#: Long texts are hashed in pieces of about this many bytes, which bounds the words held.
PIECE = 1 << 20
SLICE_BYTES = 4 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(raw: bytes):
    """The hashes of the shingles of a text, in arrays of a piece each; of fewer words than a
    shingle has, the hash of all of them together."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words, start, some = [], 0, False
    while start < len(raw):
        cut = _SPACE.search(raw, start + PIECE)
        end = cut.start() if cut else len(raw)
        words += raw[start:end].lower().split()  # of bytes: A-Z only, and the white space of the word rule
        if len(words) >= SHINGLE:
            some = True
            yield np.array([xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(SHINGLE)), strict=False)], dtype="<u8")
            words = words[1 - SHINGLE :]
        start = end
    if words and not some:
        yield np.array([xxh64_intdigest(b" ".join(words), SEED)], dtype="<u8")


def fingerprint(raw: bytes | None) -> int:
    """Of a text in UTF-8, as a signed 64-bit number; 0 for null and for a text without words."""
    import numpy as np

    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(raw or b""):
        n += len(hashes)
        for part in np.array_split(hashes, len(hashes) // 4096 + 1):
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` per row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in (part for whole in batches for part in slices(whole, 1, SLICE_BYTES)):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, fp long")


def ball_links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints ``fps(fp)``: a spanning part of all
    pairs within RADIUS, with the same components."""
    bit = fps.select("fp", F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit"))
    one = F.expr("CASE WHEN bit < 0 THEN 0L ELSE shiftleft(1L, bit) END")
    met = bit.select(F.col("fp").bitwiseXOR(one).alias("variant"), one.alias("mask"), (F.col("bit") < 0).alias("own"))
    balls = met.groupBy("variant").agg(F.bit_or("mask").alias("mask"), F.max("own").alias("own")).where("bit_count(mask) + CAST(own AS INT) > 1")
    members = F.expr("concat(IF(own, array(variant), CAST(array() AS array<bigint>)), transform(filter(sequence(0, 63), b -> (shiftright(mask, b) & 1L) = 1L), b -> variant ^ shiftleft(1L, b)))")
    pairs = balls.select(F.explode(let(members, lambda m: F.transform(m, lambda x: F.struct(F.array_min(m).alias("a"), x.alias("b"))))).alias("p")).select("p.a", "p.b")
    return pairs.where("a <> b").distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id)`` per row of ``docs``: 16 lower-case hex digits, and
    the least id that links reach, the row's own included.

    Null and empty texts and texts without words have the fingerprint zero, which links like
    any other; texts of any length are hashed whole, a piece at a time; repeated rows and
    ties stay, a row each; null ids are passed over for the least id, and a component in
    which all ids are null has a null one.  Further columns are not read, and an empty table
    gives an empty result."""
    rows = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    links = stored(ball_links(classes.select("fp")), "links")
    labels = classes
    if not links.isEmpty():
        joined = classes.join(components(links).toDF("fp", "root"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        least = joined.groupBy("root").agg(F.min("first").alias("component"))
        labels = stored(joined.join(least, "root").select("fp", F.col("component").alias("first")), "labels")
        removed(classes)
    removed(links)
    return rows.join(labels, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id"))
