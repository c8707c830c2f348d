"""Text, typed JSON and sliced sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, cells: str, path: str, order: list | None = None) -> None:
    """Rows of text cells, tab-separated; rows may be of unequal length.  With ``order`` the
    part files in their order hold the rows in that order."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    ordered.select(F.array_join(F.transform(cells, lambda x: x.cast("string")), "\t")).write.text(path)


def write_map(df: DataFrame, column: str, path: str) -> None:
    """Entries of a map column as two tab-separated columns."""
    rows = df.select(F.explode(F.map_entries(column)).alias("e"))
    rows.select(F.concat_ws("\t", F.col("e.key").cast("string"), F.col("e.value").cast("string"))).write.text(path)


def write_outputs(df: DataFrame, path: str, drop_nulls: bool) -> None:
    """JSON records; tasks leave null fields out, fragments keep them."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(drop_nulls).lower()})).write.text(path)


def split_slices(df: DataFrame, key: str, path: str) -> None:
    """A folder for each value of the key; reading one back prunes the others."""
    df.write.partitionBy(key).parquet(path)


def sort_lines(df: DataFrame, path: str, line: str = "line") -> None:
    """Sorted text, in the byte order of UTF-8."""
    df.select(line).orderBy(line).write.text(path)
