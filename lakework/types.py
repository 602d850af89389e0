"""Schemas from short text, without a session (executors import them too)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "binary": T.BinaryType(), "array<string>": T.ArrayType(T.StringType()),
}


def struct(text: str) -> T.StructType:
    """``name type, name type`` as a struct of nullable fields."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))])
