"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule, as a regular expression class and as text.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\f\r"
#: A word, as the contracts of the queries define it.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside lambdas of
    higher-order functions, where a plain expression would be evaluated anew for
    every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+")
    return F.filter(parts, lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter alone."""
    return F.translate(text, UPPER, LOWER)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where that is unset, a local session (as in tests) uses a folder under its
    warehouse; on a cluster that folder may be each machine's own, so there it fails."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Rows of an Arrow batch while a frame is stored: rows are texts, and Spark's own limit
#: counts rows only, so that a batch of long ones would fill the memory beside the heap.
BATCH_ROWS = 2000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there,
    and a lost executor costs no earlier stage again."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    rows = int(spark.conf.get(_BATCH_CONF))
    spark.conf.set(_BATCH_CONF, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_CONF, str(rows))
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def removed(*frames: DataFrame) -> None:
    """Delete the folders of stored frames that nothing reads any more."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.folder)
        path.getFileSystem(conf).delete(path, True)


def slices(batch, column: int, size: int):
    """Parts of an Arrow batch with about ``size`` bytes of text in a column each."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows or not batch.num_rows:
        yield batch.slice(start)
