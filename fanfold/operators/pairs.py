"""Positional pairing, nested scatter and transposition of long tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zip_tables(a: DataFrame, b: DataFrame, keys: list[str], seq: str = "seq", strict: bool = True) -> DataFrame:
    """Rows of ``a`` and ``b`` with equal keys and positions.  With ``strict`` a position that
    one side lacks is an error; else such rows go."""
    if not strict:
        return a.join(b, [*keys, seq])
    left, right = a.withColumn("_l", F.lit(True)), b.withColumn("_r", F.lit(True))
    both = left.join(right, [*keys, seq], "full")
    ok = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return both.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("zip: tables of unequal length")))).drop("_l", "_r")


#: Rows of the inner collection that a nested scatter takes at most: it is broadcast.
MOST_INNER = 100_000


def nested_scatter(outer: DataFrame, inner: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """Every outer row with every inner row; ``inner`` is the collection that the outer ones
    share.  It is broadcast, so more than MOST_INNER rows of it are an error."""
    if inner.limit(MOST_INNER + 1).count() > MOST_INNER:
        raise ValueError(f"nested scatter over more than {MOST_INNER} inner rows")
    return outer.crossJoin(F.broadcast(inner)).withColumn(name, value)


def scatter_env(items: DataFrame, env: DataFrame) -> DataFrame:
    """Each item sees the variables of the one-row ``env``; no row or several are an error."""
    one = env.agg(F.count("*").alias("_n"), F.first(F.struct(*env.columns)).alias("_env"))
    checked = F.when(F.col("_n") == 1, F.col("_env")).otherwise(F.raise_error(F.concat(F.lit("an environment has one row, not "), F.col("_n").cast("string"))))
    return items.crossJoin(F.broadcast(one.select(checked.alias("_env")))).select(*items.columns, "_env.*")


def transpose(cells: DataFrame, row: str = "r", column: str = "c") -> DataFrame:
    """Rows and columns of ``(row, column, value)`` cells swapped."""
    return cells.select(F.col(column).alias(row), F.col(row).alias(column), *(c for c in cells.columns if c not in (row, column)))


def check_rectangular(cells: DataFrame, row: str = "r") -> DataFrame:
    """Widths of the matrix with their numbers of rows; more than one row: it is ragged."""
    return cells.groupBy(row).agg(F.count("*").alias("width")).groupBy("width").agg(F.count("*").alias("rows"))


def pair_chunks(first: DataFrame, *more: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Tables joined by chunk; a chunk that one lacks is an error."""
    for df in more:
        first = zip_tables(first, df, [], key)
    return first


def sub_flow(df: DataFrame, flow: Callable[..., DataFrame], **bindings) -> DataFrame:
    """A named, parameterised flow."""
    return df.transform(flow, **bindings)
