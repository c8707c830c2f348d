"""Global positions without a window over all rows.

Rows are range-partitioned on the order keys and written to the shared folder (range
bounds are sampled, so both passes must see one layout); rows are counted per part, the
few counts are accumulated, and each part numbers its own rows from there.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which driver and executors share.  Where it is unset a local
    session uses a folder under its warehouse; on a cluster that may be each machine's own
    disk, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    path = os.path.join(shared_folder(df.sparkSession), f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_positions(df: DataFrame, order: list, name: str = "seq") -> DataFrame:
    """Add a dense position from 0 by ``order``; ties fall as the parts have them, so give
    an order without ties for a repeatable result."""
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(counts.select("_part", before.alias("_before")))  # a row for each shuffle partition
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.withColumn("_inner", inner).join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_inner") - 1).drop("_part", "_inner", "_before")


def with_ranks(df: DataFrame, keys: list[str], order: list, name: str = "rank") -> DataFrame:
    """Add a dense position from 0 within the rows of equal ``keys``, by ``order``; null keys
    are a key.  Ties fall as their other columns' digest has them, and repeated rows alike.

    A window on the keys would send all rows of one key to one task.  Here rows are
    range-partitioned on keys, order and digest, so a hot key is spread over parts; each part
    ranks its own rows, and only a part's first key can go on from an earlier part, so what
    is broadcast is at most a row for each part."""
    digest = F.xxhash64(*(f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()))
    cut = df.withColumn("_digest", digest)
    parts = stored(cut.repartitionByRange(*keys, *order, "_digest").withColumn("_part", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("_part", *keys).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    later = counts.withColumn("_before", before).where("_before IS NOT NULL")
    offsets = later.select(F.col("_part").alias("_p"), "_before", *(F.col(k).alias(f"_k_{k}") for k in keys))
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inner = F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order, "_digest"))
    ranked = parts.withColumn("_inner", inner).join(F.broadcast(offsets), same, "left")
    return ranked.select(*df.columns, (F.coalesce("_before", F.lit(0)) + F.col("_inner") - 1).alias(name))


def chunk(df: DataFrame, size: int = 500, seq: str = "seq", most: int = 1000) -> DataFrame:
    """Add ``chunk``, the number of the chunk of ``size`` positions."""
    if not 0 < size <= most:
        raise ValueError(f"chunk size {size}: must be 1 to {most}")
    return df.withColumn("chunk", F.floor(F.col(seq) / size).cast("long"))


def batches(ids: DataFrame, by: str, order: str, size: int = 1000) -> DataFrame:
    """Add ``batch``: ids of each group in slices of ``size``."""
    return with_ranks(ids, [by], [order], "batch").withColumn("batch", F.floor(F.col("batch") / size).cast("long"))


def head(lines: DataFrame, n: int, file: str = "file", order: str = "line_no") -> DataFrame:
    """The first ``n`` lines of each file."""
    rn = F.row_number().over(Window.partitionBy(file).orderBy(order))
    return lines.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def best_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row for each key, the first by ``order``.  ``min_by`` keeps one row a task before
    the shuffle, so a hot key doesn't gather in one."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def bucket_sort_merge(df: DataFrame, bucket, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows by bucket, then key, in range partitions; and the rows of each bucket."""
    marked = df.withColumn("bucket", bucket)
    ordered = marked.repartitionByRange(F.col("bucket").asc_nulls_last(), key).sortWithinPartitions(F.col("bucket").asc_nulls_last(), key)
    return ordered, marked.groupBy("bucket").agg(F.count("*").alias("n"))


def unique_paths(files: DataFrame, root: str, name: str = "name", order: str = "id", most: int = 200) -> DataFrame:
    """Add ``path``: ``root/name`` for the first file of a name, ``root/1/name`` and so on
    for the next; more than ``most`` further ones are an error."""
    rn = F.col("_rank")
    where = F.when(rn == 0, F.lit(root)).when(rn <= most, F.concat(F.lit(root + "/"), rn.cast("string"))).otherwise(F.raise_error(F.concat(F.lit("too many files named "), F.col(name))))
    return with_ranks(files, [name], [order], "_rank").withColumn("path", F.concat(where, F.lit("/"), F.col(name))).drop("_rank")
