"""Merging of layers, grants, definitions and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Access levels from the least.
LEVELS = ("NONE", "VIEW", "UPLOAD", "CONTRIBUTE", "ADMINISTER")


def merge_overrides(base: DataFrame, *layers: DataFrame, key: str, value: str = "value") -> DataFrame:
    """The latest value per key that isn't missing; all keys of all layers stay."""
    rows = base.select(key, F.lit(0).alias("_layer"), value)
    for i, layer in enumerate(layers, 1):
        rows = rows.unionByName(layer.select(key, F.lit(i).alias("_layer"), value))
    return rows.groupBy(key).agg(F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col("_layer"))).alias(value))


def unused_keys(layer: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Keys of a layer that nothing takes."""
    return layer.join(used, key, "left_anti")


def merge_access(grants: DataFrame, key: str = "key", levels=("project", "all_projects"), flags=("developer", "project_creation"), lists=("network",)) -> DataFrame:
    """Per key the highest level, any flag, the union of lists; missing ones are ignored."""
    order = F.array(*map(F.lit, LEVELS))
    rank = lambda c: F.array_position(order, F.col(c))
    aggs = [F.get(order, (F.max(rank(c)) - 1).cast("int")).alias(c) for c in levels]
    aggs += [F.bool_or(c).alias(c) for c in flags]
    aggs += [F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in lists]
    return grants.groupBy(key).agg(*aggs)


def merge_definitions(bundles: DataFrame, mode: str = "fail") -> DataFrame:
    """``(name, definition)`` of all bundles; a name with two different ones is an error."""
    both = bundles.groupBy("name").agg(F.min("definition").alias("definition"), F.max("definition").alias("_other"))
    clash = F.col("definition") != F.col("_other")
    if mode == "report":
        return both.where(clash).select("name")
    return both.select("name", F.when(clash, F.raise_error(F.concat(F.lit("two definitions of "), F.col("name")))).otherwise(F.col("definition")).alias("definition"))


def holds_text(kind) -> bool:
    """Whether values of a type have text leaves."""
    if isinstance(kind, T.ArrayType):
        return holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return holds_text(kind.keyType) or holds_text(kind.valueType)
    return any(holds_text(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else isinstance(kind, T.StringType)


def find_refs(df: DataFrame, cols: list[str], keys: list[str], is_ref=None) -> DataFrame:
    """All text leaves of nested columns that ``is_ref`` accepts, as rows ``(keys, ref)``."""
    is_ref = is_ref or (lambda c: F.contains(c, F.lit("://")))

    def leaves(c, kind):
        if isinstance(kind, T.StringType):
            return F.array(c)
        if isinstance(kind, T.ArrayType):
            return F.flatten(F.array_compact(F.transform(c, lambda x: leaves(x, kind.elementType))))
        if isinstance(kind, T.MapType):
            both = [leaves(f(c), T.ArrayType(t)) for f, t in ((F.map_keys, kind.keyType), (F.map_values, kind.valueType)) if holds_text(t)]
            return F.concat(*both) if both else F.array().cast("array<string>")
        parts = [F.coalesce(leaves(c[f.name], f.dataType), F.array().cast("array<string>")) for f in kind.fields if holds_text(f.dataType)]
        return F.concat(*parts)

    rows = [df.select(*keys, F.explode(leaves(F.col(c), df.schema[c].dataType)).alias("ref")) for c in cols if holds_text(df.schema[c].dataType)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.where(is_ref(F.col("ref")))


def find_refs_in_text(df: DataFrame, column: str, keys: list[str], pattern: str) -> DataFrame:
    """What the first group of a pattern matches in a text, as rows."""
    return df.select(*keys, F.explode(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(1))).alias("ref"))


def find_refs_in_json(df: DataFrame, column: str, keys: list[str], pattern: str = "file-[A-Za-z0-9]+", in_keys: bool = False) -> DataFrame:
    """Text values of raw JSON at any depth that are ids as a whole, as rows ``(keys, ref)``;
    with ``in_keys`` names of fields too.  Bad JSON is an error, null has no rows.

    The JSON is parsed and written anew, so that each text in it is a run of plain and
    escaped characters between quotes, and a name is one before a colon; escapes are undone
    by parsing the text alone.  An id inside a longer text, or behind an escaped quote, is none."""
    plain = F.to_json(F.parse_json(column))
    texts = F.regexp_extract_all(plain, F.lit(r'("(?:[^"\\]|\\.)*+":?)'), F.lit(1))
    named = F.endswith(F.col("_text"), F.lit(":"))
    found = df.select(*keys, F.explode(texts).alias("_text"))
    found = found if in_keys else found.where(~named)
    ref = F.variant_get(F.parse_json(F.when(named, F.expr("left(_text, length(_text) - 1)")).otherwise(F.col("_text"))), "$", "string")
    return found.select(*keys, ref.alias("ref")).where(F.rlike("ref", F.lit(f"^(?:{pattern})\\z")))


def translate_refs(df: DataFrame, column: str, table: DataFrame, keys: list[str], required: bool = True, is_ref=None) -> DataFrame:
    """Replace the references in a column through ``table(ref, target)``, in text, arrays, maps
    (keys and values) and structs at any depth; ``is_ref`` tells which texts are references,
    all by default.  A missing one is an error, or null if not required (a map key stays as
    it is).  Order, nulls and repeated rows stay; of several targets the least counts."""
    kind = df.schema[column].dataType
    if not holds_text(kind):
        return df
    is_ref = is_ref or F.isnotnull
    refs = find_refs(df, [column], keys, is_ref).distinct()
    met = refs.join(table.groupBy("ref").agg(F.min("target").alias("target")), "ref", "left")
    target = F.col("target")
    if required:
        target = F.when(target.isNull(), F.raise_error(F.concat(F.lit("unknown reference: "), F.col("ref")))).otherwise(target)
    found = met.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("ref", target.alias("target")))).alias("_targets"))

    def put(c, kind):
        if isinstance(kind, T.StringType):
            return F.when(is_ref(c), F.try_element_at(F.col("_targets"), c)).otherwise(c)
        if not holds_text(kind):
            return c
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: put(x, kind.elementType))
        if isinstance(kind, T.MapType):
            values = F.transform_values(c, lambda _, v: put(v, kind.valueType))
            return F.transform_keys(values, lambda k, _: F.coalesce(put(k, kind.keyType), k))
        return F.when(c.isNotNull(), F.struct(*(put(c[f.name], f.dataType).alias(f.name) for f in kind.fields)))

    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = df.join(found.withColumnsRenamed({k: f"_k_{k}" for k in keys}), same, "left")
    return joined.withColumn(column, put(F.col(column), kind)).select(*df.columns)
