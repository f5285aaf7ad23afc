"""Typed values from VARIANT values, following a table schema. SQL expression text in and out."""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.functions import variants as V
from millrace.functions.jsonschema import raw_key


def decode_value(value: str, data_type: T.DataType, depth: int = 0) -> str:
    """The column of one value; a null or missing value is NULL.

    Nothing is raised here, since decoding may run ahead of the checks, which see every row.
    """
    if isinstance(data_type, T.NullType):
        return "NULL"
    if isinstance(data_type, T.StructType):
        return f"if({V.is_null(value)}, NULL, {decode_object(value, data_type, depth)})"
    if isinstance(data_type, T.ArrayType):
        x = f"x{depth}"
        inner = decode_value(x, data_type.elementType, depth + 1)
        return f"transform({V.elements(value)}, {x} -> {inner})"
    if V.is_format(data_type):
        return V.parse_format(V.text(value), data_type)
    if isinstance(data_type, T.FloatType):
        # By way of double, so that a decimal is rounded the same way as a double.
        return f"cast(try_variant_get({value}, '$', 'double') AS float)"
    return f"try_variant_get({value}, '$', '{data_type.simpleString()}')"


def decode_object(value: str, struct: T.StructType, depth: int = 0) -> str:
    """The columns of an object as a struct; keys the schema does not name are left out."""
    fields = (
        f"{V.literal(f.name)}, {decode_value(V.child(value, raw_key(f)), f.dataType, depth)}"
        for f in struct
    )
    return f"named_struct({', '.join(fields)})"
