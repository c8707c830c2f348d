"""Text and file sources.  Spark skips empty files in its scans, so functions that count
them take the list of files as a table, which ``glob_files`` makes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import coerce
from ..operators.positions import stored
from .listing import Listing, store_of

SIZES = {"B": 1, "KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12, "KIB": 2**10, "MIB": 2**20, "GIB": 2**30, "TIB": 2**40}


def read_lines(spark: SparkSession, path, numbered: bool = False) -> DataFrame:
    """``(file, line)`` or, numbered, ``(file, line_no, line)`` with numbers from 0.

    Large files are read in splits either way.  A numbered line has the lines of the file's
    earlier splits before it and those of its own, which a task reads in order; the lines are
    written to the shared folder once, so that counting and numbering see the same splits."""
    if not numbered:
        return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    read = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.regexp_replace("value", r"\r$", "").alias("line"))
    lines = stored(read.withColumn("_id", F.monotonically_increasing_id()), "lines")
    splits = lines.groupBy("file", "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("file", "_start", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"))
    return lines.join(offsets, ["file", "_start"]).select("file", (F.col("_id") + F.col("_offset")).alias("line_no"), "line")


def read_tsv(spark: SparkSession, path) -> DataFrame:
    """``(file, row, cells)``; rows may have unequal numbers of cells; files are read in splits."""
    return read_lines(spark, path, numbered=True).select("file", F.col("line_no").alias("row"), F.split("line", "\t").alias("cells"))


def read_scalar(spark: SparkSession, path, kind: str) -> DataFrame:
    """``(file, value)`` of one-value files, without a trailing newline."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("file"), coerce(F.regexp_replace("value", r"\n$", ""), kind).alias("value"))


def glob_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """``(path, name, size, modified)`` of regular files below ``root``; none is no error.

    Tasks list the folders of a store that pyarrow opens (local, HDFS, S3, GCS), and empty
    files have the size 0.  Any other store goes by Spark's own scan, which sees none of
    these.  Names that begin with ``_`` or ``.`` are hidden, as to Spark."""
    if store_of(root) is not None:
        spark.dataSource.register(Listing)
        return spark.read.format("folder_listing").option("pattern", pattern).load(root)
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    return found.select("path", F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def in_unit(size: Column, unit: str = "B") -> Column:
    return size / F.lit(float(SIZES[unit.upper()]))


def file_size(files: DataFrame, scanned: DataFrame, unit: str = "B", path: str = "path") -> DataFrame:
    """``files`` with ``size`` from ``scanned(path, size)``; files that no scan sees are empty."""
    return files.join(scanned.select(path, "size"), path, "left").withColumn("size", in_unit(F.coalesce("size", F.lit(0)), unit))


def line_count(lines: DataFrame, files: DataFrame | None = None, file: str = "file") -> DataFrame:
    """Lines per file; with the list of files, empty ones count 0."""
    n = lines.groupBy(file).agg(F.count("*").alias("n"))
    return n if files is None else files.select(file).join(n, file, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def total_size(files: DataFrame, keys: list[str], size: str = "size") -> DataFrame:
    return files.groupBy(*keys).agg(F.sum(size).alias(size))


def literal_array(spark: SparkSession, values: list, name: str = "value") -> DataFrame:
    """A given list as rows ``(seq, value)``."""
    return spark.range(1).select(F.posexplode(F.array(*map(F.lit, values))).alias("seq", name))


def range_rows(spark: SparkSession, n: int, name: str = "value") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)


def read_gz_text(spark: SparkSession, path, partitions: int | None = None) -> DataFrame:
    """Lines of compressed text.  Such files aren't split, so rows are dealt anew if asked."""
    df = spark.read.text(path).withColumnRenamed("value", "line")
    return df.repartition(partitions) if partitions else df
