"""Scatter, ordered gather, and counts over long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scatter(df: DataFrame, arr: str, seq: str = "seq", value: str = "value") -> DataFrame:
    """A row for each element, with its position; empty and null arrays give none."""
    return df.select(*(c for c in df.columns if c != arr), F.posexplode(arr).alias(seq, value))


def gathered(seq, value) -> Column:
    """Aggregate: the values in the order of ``seq``, nulls in place."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(value).alias("v")))), lambda x: x["v"])


def gather(df: DataFrame, keys: list[str], seq: str = "seq", value: str = "value", name: str | None = None) -> DataFrame:
    """The inverse of scatter: one row for each key with the ordered array."""
    return df.groupBy(*keys).agg(gathered(seq, value).alias(name or value))


def gather_nested(df: DataFrame, keys: list[str], seqs: list[str], value: str) -> DataFrame:
    """Gather level by level, innermost last in ``seqs``."""
    for i in range(len(seqs), 0, -1):
        df = gather(df, keys + seqs[: i - 1], seqs[i - 1], value)
    return df


def gather_results(results: DataFrame, outputs: dict[str, str], key: str = "parent_id", seq: str = "seq", absent: str = "drop") -> DataFrame:
    """Arrays of output fields from ``outputs map<string,string>`` of each row, by ``seq``.

    ``outputs`` names fields and ``required`` or ``optional``.  An absent optional is dropped
    (the array gets shorter), or null with ``absent='null'``; a present null stays; an
    absent required field is an error."""
    aggs = []
    for name, how in outputs.items():
        there = F.map_contains_key("outputs", name)
        value = F.element_at("outputs", F.lit(name))
        if how == "required":
            value = F.when(there, value).otherwise(F.raise_error(F.lit(f"missing output: {name}")))
            there = F.lit(True)
        row = F.struct(F.col(seq).alias("s"), value.alias("v"))
        row = row if absent == "null" else F.when(there, row)
        aggs.append(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["v"]).alias(name))
    return results.groupBy(key).agg(*aggs)


def order_by_seq(results: DataFrame, seq: str = "seq") -> DataFrame:
    """Results in the order of their launch; for output only."""
    return results.orderBy(seq)


def sum_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(value))


def count_per_key(df: DataFrame, key: str, every: DataFrame | None = None) -> DataFrame:
    """Rows per key; with ``every(key)`` keys without rows count 0."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    return n if every is None else every.join(n, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def merge_counts(chunks: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Counts of chunks added up."""
    return chunks.groupBy(key).agg(F.sum(n).alias(n))


def flatten_union(first: DataFrame, *more: DataFrame) -> DataFrame:
    for df in more:
        first = first.unionByName(df)
    return first
