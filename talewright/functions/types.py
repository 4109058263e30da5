"""Types of UDF results, built without a session so that workers can import them."""

from __future__ import annotations

from pyspark.sql import types as T

_NAMES = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "binary": T.BinaryType(), "float": T.FloatType()}


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, of(v)) for k, v in fields.items()])


def array(element) -> T.ArrayType:
    return T.ArrayType(of(element))


def of(kind) -> T.DataType:
    return _NAMES[kind] if isinstance(kind, str) else kind
