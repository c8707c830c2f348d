"""Typed JSON: two encodings of nested values, and user input records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import col, fail_unless


def _wire(kind: T.DataType, style: str) -> T.DataType:
    """The type of the JSON value of ``kind``."""
    if isinstance(kind, T.MapType):
        value = _wire(kind.valueType, style)
        if style == "internal" and isinstance(kind.keyType, T.StringType):
            return T.MapType(T.StringType(), value)
        return T.StructType([T.StructField("keys", T.ArrayType(_wire(kind.keyType, style))), T.StructField("values", T.ArrayType(value))])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_wire(kind.elementType, style))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _wire(f.dataType, style)) for f in kind.fields])
    return kind


def _encode(c: Column, kind: T.DataType, style: str) -> Column:
    if isinstance(kind, T.MapType):
        inner = lambda x: _encode(x, kind.valueType, style)
        if style == "internal" and isinstance(kind.keyType, T.StringType):
            return F.transform_values(c, lambda k, v: inner(v))
        keys = F.transform(F.map_keys(c), lambda x: _encode(x, kind.keyType, style))
        return F.when(c.isNotNull(), F.struct(keys.alias("keys"), F.transform(F.map_values(c), inner).alias("values")))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _encode(x, kind.elementType, style))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(_encode(c[f.name], f.dataType, style).alias(f.name) for f in kind.fields)))
    return c


def _decode(c: Column, kind: T.DataType, style: str) -> Column:
    if isinstance(kind, T.MapType):
        inner = lambda x: _decode(x, kind.valueType, style)
        if style == "internal" and isinstance(kind.keyType, T.StringType):
            return F.transform_values(c, lambda k, v: inner(v))
        keys, values = F.transform(c["keys"], lambda x: _decode(x, kind.keyType, style)), F.transform(c["values"], inner)
        return F.when(c.isNotNull(), fail_unless(F.size(keys) == F.size(values), F.map_from_arrays(keys, values), "a map with unequal keys and values"))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _decode(x, kind.elementType, style))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(_decode(c[f.name], f.dataType, style).alias(f.name) for f in kind.fields)))
    return c


def encode_typed(column, kind: T.DataType, style: str = "internal") -> Column:
    """JSON text of a value.  *internal*: maps with text keys are objects, others have keys
    and values; *platform*: all maps have keys and values, and nested values are wrapped in
    ``___``.  Missing values are null."""
    value = _encode(col(column), kind, style)
    if style == "platform" and isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
        value = F.struct(value.alias("___"))
    return F.get_json_object(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}), "$.v")


def decode_typed(column, kind: T.DataType, style: str = "internal") -> Column:
    """The value of JSON text that encode_typed writes; bad text is an error."""
    wire = _wire(kind, style)
    if style == "platform" and isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
        wire = T.StructType([T.StructField("___", wire)])
    text = F.concat(F.lit('{"v":'), col(column), F.lit("}"))
    if isinstance(kind, T.StringType):
        return F.when(col(column).isNotNull(), col(column))
    parsed = F.from_json(text, T.StructType([T.StructField("v", wire)]), {"mode": "FAILFAST"})["v"]
    parsed = parsed["___"] if isinstance(wire, T.StructType) and wire.names == ["___"] else parsed
    return _decode(parsed, kind, style)


def read_inputs(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Typed columns of user input records in JSON text.  Pairs are objects or two-element
    arrays, maps objects keyed by text; ``##`` names are comments."""
    out = []
    for f in schema.fields:
        raw = F.get_json_object(column, f"$['{f.name}']")
        out.append(input_value(raw, f.dataType).alias(f.name))
    return df.select(*df.columns, *out)


def input_value(raw: Column, kind: T.DataType) -> Column:
    """A value of input text: ``raw`` is the JSON (or plain) text of the value."""
    if isinstance(kind, T.StructType) and kind.names == ["left", "right"]:
        at = lambda name, i: F.coalesce(F.get_json_object(raw, f"$.{name}"), F.get_json_object(raw, f"$[{i}]"))
        return F.when(raw.isNotNull(), F.struct(input_value(at("left", 0), kind["left"].dataType).alias("left"), input_value(at("right", 1), kind["right"].dataType).alias("right")))
    if isinstance(kind, T.ArrayType):
        items = F.from_json(raw, T.ArrayType(T.StringType()))
        return F.transform(items, lambda x: input_value(x, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.map_filter(F.from_json(raw, T.MapType(T.StringType(), T.StringType())), lambda k, v: ~k.startswith("##"))
        return F.map_from_arrays(F.transform(F.map_keys(entries), lambda k: k.cast(kind.keyType)), F.transform(F.map_values(entries), lambda v: input_value(v, kind.valueType)))
    if isinstance(kind, T.StructType):
        return F.when(raw.isNotNull(), F.struct(*(input_value(F.get_json_object(raw, f"$['{f.name}']"), f.dataType).alias(f.name) for f in kind.fields)))
    return raw.cast(kind)
