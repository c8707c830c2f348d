"""Type names of the workflow types, to and from Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

#: Serialized names of the primitive types.
PRIMITIVES = {"Boolean": T.BooleanType(), "Integer": T.IntegerType(), "Long": T.LongType(), "Float": T.DoubleType(), "String": T.StringType(), "SingleFile": T.StringType()}


def pair(left: T.DataType, right: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("left", left), T.StructField("right", right)])


def from_name(name: str, structs: dict[str, T.StructType] | None = None) -> T.DataType:
    """The Spark type of a serialized name.  Maps keyed by maps become arrays of pairs; a
    double optional is an error; so is an unknown name."""
    name = name.strip()
    if name in PRIMITIVES:
        return PRIMITIVES[name]
    m = re.fullmatch(r"(\w+)\[(.*)\]", name)
    if m is None:
        if structs and name in structs:
            return structs[name]
        raise ValueError(f"unknown type: {name}")
    kind, parts = m[1], [from_name(x, structs) for x in _arguments(m[2])]
    if kind == "Option":
        if m[2].strip().startswith("Option["):
            raise ValueError(f"double optional: {name}")
        return parts[0]
    if kind in ("MaybeEmptyArray", "NonEmptyArray"):
        return T.ArrayType(parts[0])
    if kind == "Pair":
        return pair(*parts)
    if kind == "Map":
        return T.ArrayType(pair(*parts)) if holds_map(parts[0]) else T.MapType(*parts)
    raise ValueError(f"unknown type: {name}")


def holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return holds_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(holds_map(f.dataType) for f in kind.fields)


def to_name(kind: T.DataType) -> str:
    """The serialized name of a Spark type; unnamed structs other than pairs are an error."""
    for name, t in PRIMITIVES.items():
        if kind == t and name != "SingleFile":
            return name
    if isinstance(kind, T.ArrayType):
        return f"MaybeEmptyArray[{to_name(kind.elementType)}]"
    if isinstance(kind, T.MapType):
        return f"Map[{to_name(kind.keyType)}, {to_name(kind.valueType)}]"
    if isinstance(kind, T.StructType) and kind.names == ["left", "right"]:
        return f"Pair[{to_name(kind['left'].dataType)}, {to_name(kind['right'].dataType)}]"
    raise ValueError(f"no name for {kind.simpleString()}")


def _arguments(text: str) -> list[str]:
    out, depth, start = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "[") - (c == "]")
        if c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]
