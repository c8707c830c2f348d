"""Dependent expressions, coercion, branches and input binding."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import col, fail_unless


def coerce(value, kind: str | T.DataType) -> Column:
    """Cast with the coercions of bindings: text to numbers (digits exactly, also before
    a point, which is cut there; text with an exponent to a whole number by way of double), numbers to text,
    ``true``/``false`` to boolean.  Bad text is an error, as ANSI casts are."""
    kind = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
    v = col(value)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        text = v.cast("string")
        digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(?:\.[0-9]*)?\s*$", 1)
        of_text = F.when(digits != "", digits.cast(kind)).otherwise(text.cast("double").cast(kind))
        return F.when(F.typeof(v) == "string", of_text).otherwise(v.cast(kind))
    return v.cast(kind)


def with_exprs(df: DataFrame, exprs: list[tuple[str, str, str]]) -> DataFrame:
    """Add ``(name, SQL expression, type)`` columns in the order of their dependencies; a
    cycle is an error."""
    import re

    by_name = {n: (e, t) for n, e, t in exprs}
    needs = {n: {w for w in re.findall(r"[A-Za-z_]\w*", e) if w in by_name and w != n} for n, (e, _) in by_name.items()}
    try:
        order = list(TopologicalSorter(needs).static_order())
    except CycleError as e:
        raise ValueError(f"expressions depend on each other: {e.args[1]}") from None
    return reduce(lambda d, n: d.withColumn(n, F.expr(by_name[n][0]).cast(by_name[n][1])), order, df)


def bool_if(df: DataFrame, cond: Column, exprs: dict[str, Column]) -> DataFrame:
    """Add columns that are null where ``cond`` isn't true."""
    return df.withColumns({n: F.when(cond, e) for n, e in exprs.items()})


def row_if(df: DataFrame, cond: Column, fn: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """Run ``fn`` for the rows where ``cond`` is true only; the others get nulls in the
    columns that it adds.  ``keys`` tell rows apart: rows with equal keys multiply."""
    done = fn(df.where(cond))
    new = [c for c in done.columns if c not in df.columns]
    return df.join(done.select(*keys, *new), keys, "left")


def _supplied(text: Column, kind: str, name: str) -> Column:
    from ..sources.typed import input_value

    kind = T.DataType.fromDDL(kind)
    if not isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return text.cast(kind)
    shape = {T.ArrayType: r"^\s*\[", T.MapType: r"^\s*\{", T.StructType: r"^\s*[\[{]"}[type(kind)]
    text = F.when(F.trim(text) != "null", text)
    value = input_value(text, kind)
    return fail_unless(text.isNull() | (text.rlike(shape) & F.get_json_object(text, "$").isNotNull() & value.isNotNull()), value, f"input {name} is not a {kind.simpleString()}")


def bind_inputs(df: DataFrame, supplied: str, spec: list[tuple[str, str, str, str | None]]) -> DataFrame:
    """Resolve inputs from the ``map<string,string>`` column ``supplied`` by
    ``(name, type, kind, SQL default)``: *required* missing is an error, *default* missing
    takes the default (which may use inputs before it), *fixed* supplied is an error,
    *optional* missing or null is null.  Present and null differ.

    Arrays, maps, pairs and structs are supplied as JSON text in the forms of input
    records (``sources.typed.input_value``) and may nest; text that isn't of the type is
    an error, JSON ``null`` is null."""
    m = F.col(supplied)
    for name, kind, how, default in spec:
        there, value = F.map_contains_key(m, name), _supplied(F.element_at(m, F.lit(name)), kind, name)
        if how == "required":
            out = fail_unless(there & value.isNotNull(), value, f"missing input: {name}")
        elif how == "default":
            out = F.when(there, value).otherwise(F.expr(default).cast(kind))
        elif how == "fixed":
            out = fail_unless(~there, F.expr(default).cast(kind), f"fixed input supplied: {name}")
        else:
            out = F.when(there, value)
        df = df.withColumn(name, out)
    return df


FLAT = "___"


def rename_flat(df: DataFrame) -> DataFrame:
    """Dots in column names as three underscores; names that hold those already are refused."""
    if bad := [c for c in df.columns if FLAT in c]:
        raise ValueError(f"names with {FLAT}: {bad}")
    return df.toDF(*(c.replace(".", FLAT) for c in df.columns))


def unrename(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.replace(FLAT, ".") for c in df.columns))


def export_only(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*names)
