"""Predicates and row checks.  Checks have two modes: ``fail`` raises at the first bad
value, ``report`` returns the violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grep_count(lines: DataFrame, patterns: list[str], file: str = "file", line: str = "line") -> DataFrame:
    """``(file, pattern, n)``: lines that match each regular expression, zeros included.
    One pass counts all patterns; they are a parameter, so a column each."""
    counts = lines.groupBy(file).agg(*(F.count_if(F.col(line).rlike(p)).alias(f"p{i}") for i, p in enumerate(patterns)))
    rows = F.array(*(F.struct(F.lit(p).alias("pattern"), F.col(f"p{i}").alias("n")) for i, p in enumerate(patterns)))
    return counts.select(file, F.explode(rows).alias("r")).select(file, "r.pattern", "r.n")


def choices(df: DataFrame, column: str, values: list, mode: str = "fail") -> DataFrame:
    """The column, or every element of an array column, is one of ``values``; nulls pass."""
    dtype = df.schema[column].dataType
    is_array = dtype.typeName() == "array"
    kind = dtype.elementType if is_array else dtype
    wrong = [v for v in values if isinstance(v, str) != (kind.typeName() == "string")]
    if wrong:
        raise TypeError(f"choices of another type than {kind.simpleString()}: {wrong}")
    ok = F.forall(column, lambda x: x.isin(*values)) if is_array else F.col(column).isin(*values)
    ok = F.coalesce(ok, F.lit(True))
    if mode == "report":
        return df.where(~ok)
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(f"{column}: not one of the choices"))))


def glob_pattern(glob: str) -> str:
    """A glob as a regular expression for whole names."""
    import re

    return "^" + "".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in glob) + "$"


def patterns(names: list[str] | None = None, klass: str | None = None, tags: list[str] | None = None, *, name_col: str = "name", class_col: str = "class", tags_col: str = "tags") -> Column:
    """A file row fits: its name any of the globs, its class, all of the tags; parts left out
    ask for nothing."""
    out = F.lit(True)
    if names:
        some = F.lit(False)
        for g in names:
            some = some | F.col(name_col).rlike(glob_pattern(g))
        out = out & some
    if klass is not None:
        out = out & (F.col(class_col) == klass)
    for t in tags or ():
        out = out & F.array_contains(tags_col, t)
    return out


def constraint_tree(tree, leaf) -> Column:
    """A nested ``{"and": [...]}`` / ``{"or": [...]}`` tree of tags as one condition; ``leaf``
    makes a condition of a tag.  A node has exactly one key."""
    if isinstance(tree, str):
        return leaf(tree)
    if len(tree) != 1 or (op := next(iter(tree))) not in ("and", "or"):
        raise ValueError(f"a constraint node has one key, and or or: {tree}")
    parts = [constraint_tree(x, leaf) for x in tree[op]]
    out = parts[0]
    for p in parts[1:]:
        out = out & p if op == "and" else out | p
    return out


def typed_defaults(df: DataFrame, spec: dict[str, object]) -> DataFrame:
    """Fill nulls with defaults, which must have the type of their column."""
    kinds = {"string": str, "integer": int, "long": int, "double": float, "boolean": bool}
    for name, value in spec.items():
        kind = df.schema[name].dataType.typeName()
        if type(value) is not kinds.get(kind):
            raise TypeError(f"default of {name} isn't {kind}: {value!r}")
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType)))
    return df


def live_only(files: DataFrame, state: str = "archival_state", mode: str = "fail") -> DataFrame:
    """Rows in state ``live``; others are an error, or reported."""
    ok = F.coalesce(F.col(state) == "live", F.lit(False))
    if mode == "report":
        return files.where(~ok)
    return files.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("a file is not live"))))


def validate_rows(df: DataFrame, rules: dict[str, Column], by: str, mode: str = "SUMMARY") -> DataFrame:
    """Rules that hold for good rows.  VERBOSE: each broken rule of each row; SUMMARY: broken
    rows per ``by`` and rule."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    rows = df.withColumn("rule", F.explode(broken))
    return rows if mode == "VERBOSE" else rows.groupBy(by, "rule").agg(F.count("*").alias("n"))
