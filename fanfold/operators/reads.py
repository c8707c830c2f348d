"""Batch jobs over sequencing reads: ``(read_id, gem_group, barcode, barcode_qual, umi,
umi_min_qual, gene)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .positions import chunk, with_positions, with_ranks

def subsample(reads: DataFrame, rate: float, seed: int = 0, key: str = "read_id") -> DataFrame:
    """A repeatable share of the reads, by the first 32 bits of the MD5 of seed and id."""
    bits = F.conv(F.left(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), F.lit(8)), 16, 10)
    return reads.where(bits.cast("long") < int(rate * (1 << 32)))


def chunk_reads(reads: DataFrame, reads_per_file: int, order: str = "read_id") -> DataFrame:
    """Add ``chunk``: the reads in order, ``reads_per_file`` to a chunk."""
    return chunk(with_positions(reads, [F.col(order)]), reads_per_file, most=reads_per_file)


def barcode_counts(reads: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Exact matches per group and listed barcode."""
    return reads.join(whitelist.select("barcode").distinct(), "barcode", "left_semi").groupBy("gem_group", "barcode").agg(F.count("*").alias("n"))


def _gaps(barcode: str) -> Column:
    """``(at, rest)`` for each base: the place, and the barcode without that base.  Barcodes of
    equal length with one mismatch share one."""
    at = F.sequence(F.lit(1), F.length(barcode))
    parts = F.transform(at, lambda i: F.struct(i.alias("at"), F.concat(F.substring(barcode, F.lit(1), i - 1), F.substring(barcode, i + 1, F.length(barcode))).alias("rest")))
    return F.explode(F.when(F.length(barcode) > 0, parts))


def correct_barcodes(reads: DataFrame, whitelist: DataFrame, counts: DataFrame, threshold: float = 0.975) -> DataFrame:
    """Reads with ``corrected``: a listed barcode as it is; else the listed barcode at one
    mismatch whose share of weight times error probability is at least ``threshold``; else
    null.  The weight of a listed barcode is its count in the read's gem group and one.

    Neighbours are found once for each distinct barcode of a group, by a join on barcodes
    without one base; each read then weighs its barcode's by its own qualities."""
    listed = whitelist.select("barcode").distinct()
    exact = listed.select(F.col("barcode").alias("_b"))
    known = reads.join(exact, F.col("barcode") == F.col("_b"), "left").withColumn("_listed", F.col("_b").isNotNull()).drop("_b")
    distinct = known.where(~F.col("_listed") & F.col("barcode").isNotNull()).select("gem_group", "barcode").distinct()
    index = listed.select(F.col("barcode").alias("candidate"), _gaps("barcode").alias("g")).select("candidate", "g.*")
    near = distinct.select("gem_group", "barcode", _gaps("barcode").alias("g")).select("gem_group", "barcode", "g.*").join(index, ["at", "rest"])
    weights = counts.groupBy("gem_group", "barcode").agg(F.sum("n").alias("n")).select(F.col("gem_group").alias("_g"), F.col("barcode").alias("_c"), "n")
    weighed = near.join(weights, F.col("gem_group").eqNullSafe(F.col("_g")) & (F.col("candidate") == F.col("_c")), "left")
    one = F.struct("at", "candidate", (F.coalesce("n", F.lit(0)) + 1).alias("weight"))
    near = weighed.groupBy(F.col("gem_group").alias("_g"), F.col("barcode").alias("_b")).agg(F.collect_list(one).alias("_near"))
    met = known.join(near, F.col("gem_group").eqNullSafe(F.col("_g")) & (F.col("barcode") == F.col("_b")), "left")
    scored = F.transform("_near", lambda c: F.struct((c["weight"] * F.pow(F.lit(10.0), -F.element_at("barcode_qual", c["at"]) / 10)).alias("p"), c["candidate"].alias("candidate")))
    met = met.withColumn("_scored", F.array_sort(scored))  # one order of addition
    best = F.array_max("_scored")
    share = best["p"] / F.aggregate("_scored", F.lit(0.0), lambda total, x: total + x["p"])
    corrected = F.when(F.col("_listed"), F.col("barcode")).when(share >= threshold, best["candidate"])
    return met.withColumn("corrected", corrected).select(*reads.columns, "corrected")


def filter_umis(reads: DataFrame, min_qual: int) -> DataFrame:
    return reads.where(F.col("umi_min_qual") >= min_qual)


def bucket(n_bases: int = 2):
    """The bucket of a read: the first bases of its barcode; null is a bucket of its own."""
    return F.substring("barcode", 1, n_bases)


def mark_duplicates(reads: DataFrame, keys=("gem_group", "barcode", "umi", "gene"), order: str = "read_id", whole=("barcode", "gene")) -> DataFrame:
    """Add ``duplicate``: another read of the same molecule comes before it, by ``order``; of
    rows with equal ids one is first.  Reads without one of ``whole`` are of no molecule and
    never duplicates.  A molecule of very many reads is ranked by several tasks."""
    of_one = F.lit(True)
    for c in whole:
        of_one = of_one & F.col(c).isNotNull()
    ranked = with_ranks(reads.where(of_one), list(keys), [F.col(order)], "_rank")
    marked = ranked.select(*reads.columns, (F.col("_rank") > 0).alias("duplicate"))
    return marked.unionByName(reads.where(~of_one).withColumn("duplicate", F.lit(False)))


def count_genes(reads: DataFrame) -> DataFrame:
    """Distinct UMIs by group, barcode and gene, in coordinate form."""
    whole = reads.where(F.col("barcode").isNotNull() & F.col("gene").isNotNull())
    return whole.groupBy("gem_group", "barcode", "gene").agg(F.count_distinct("umi").alias("umis"))


def filter_barcodes(matrix: DataFrame, expected_cells: int) -> DataFrame:
    """Rows of barcodes with a total of at least a tenth of the 99th percentile of the top
    ``expected_cells`` totals."""
    totals = matrix.groupBy("gem_group", "barcode").agg(F.sum("umis").alias("total"))
    top = totals.orderBy(F.desc("total")).limit(expected_cells)
    bar = F.broadcast(top.agg((F.percentile("total", 0.99) / 10).alias("_bar")))
    keep = totals.crossJoin(bar).where(F.col("total") >= F.col("_bar")).select("gem_group", "barcode")
    return matrix.join(keep, ["gem_group", "barcode"])


def stage_summary(**stages: DataFrame) -> DataFrame:
    """Rows of each stage as one table."""
    parts = [df.agg(F.lit(name).alias("stage"), F.count("*").alias("n")) for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
