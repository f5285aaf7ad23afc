"""JSON Schema to Spark schema.

A stream declares its columns as a JSON Schema. The mapping here is fixed at table creation:
integers and numbers are 32 bit unless ``wide_numbers`` is asked for, one or two entry type lists
decide nullability, and three string formats become date, timestamp and time columns.
"""

from __future__ import annotations

import copy

from pyspark.sql import types as T

# The prefix that sources give to their change-data columns.
CHANGE_COLUMN_PREFIX = "_ab_cdc"

# The string formats with a column type of their own.
FORMATS = {
    "date": T.DateType(),
    "date-time": T.TimestampNTZType(),
    "time": T.TimeType(3),
}

PRIMITIVES = ("null", "boolean", "integer", "number", "string")

# Field metadata entry that holds the key in the data where it differs from the column name.
RAW_KEY = "key"


def clean_name(name: str) -> str:
    """Column name of a property: no spaces or double quotes at the ends."""
    return name.strip().lstrip('"').rstrip('"')


def raw_key(field: T.StructField) -> str:
    """The key under which the value of a column stands in the data."""
    return (field.metadata or {}).get(RAW_KEY, field.name)


def type_list(schema: dict) -> list[str]:
    """Allowed JSON types of a schema node; empty when the node allows everything."""
    declared = schema.get("type")
    if declared is None:
        if "properties" in schema:
            return ["object"]
        return ["array"] if "items" in schema else []
    if isinstance(declared, str):
        return [declared]
    if not declared:
        raise ValueError("A type list needs at least one type.")
    return list(declared)


def is_object(schema: dict) -> bool:
    return "object" in type_list(schema)


def is_array(schema: dict) -> bool:
    return "array" in type_list(schema)


def to_struct(schema: dict, wide_numbers: bool = False) -> T.StructType:
    """Spark schema of a stream, columns in declared order."""
    if not isinstance(schema, dict) or not is_object(schema):
        raise ValueError("A stream schema has to be an object with properties.")
    return _struct(schema, wide_numbers)


def _struct(schema: dict, wide: bool) -> T.StructType:
    properties = schema.get("properties")
    if not properties:
        raise ValueError("An object schema needs properties.")
    fields = [_field(name, node, wide) for name, node in properties.items()]
    seen: set[str] = set()
    for field in fields:
        if field.name.lower() in seen:
            raise ValueError(f"Two properties share the column name {field.name}.")
        seen.add(field.name.lower())
    return T.StructType(fields)


def _field(name: str, node: dict, wide: bool) -> T.StructField:
    column = clean_name(name)
    data_type, nullable = _type(node, wide)
    return T.StructField(column, data_type, nullable, {RAW_KEY: name} if column != name else None)


def _type(node: dict, wide: bool) -> tuple[T.DataType, bool]:
    kinds = type_list(node)
    if not kinds:
        return T.NullType(), True
    if "object" in kinds:
        return _struct(node, wide), True
    if "array" in kinds:
        if "items" not in node:
            raise ValueError("An array schema needs items.")
        element, contains_null = _type(node["items"], wide)
        return T.ArrayType(element, contains_null), True
    unknown = [kind for kind in kinds if kind not in PRIMITIVES]
    if unknown:
        raise ValueError(f"Unknown type {unknown[0]!r} in schema.")
    if node.get("format") in FORMATS:
        return FORMATS[node["format"]], len(kinds) > 1
    # Of a longer list only the first two entries count, and the first that is not null wins.
    kind = next((k for k in kinds[:2] if k != "null"), "null")
    return _primitive(kind, wide), len(kinds) > 1


def _primitive(kind: str, wide: bool) -> T.DataType:
    return {
        "null": T.NullType(),
        "boolean": T.BooleanType(),
        "integer": T.LongType() if wide else T.IntegerType(),
        "number": T.DoubleType() if wide else T.FloatType(),
        "string": T.StringType(),
    }[kind]


def prune_change_columns(schema: dict) -> dict:
    """The schema without its top-level change-data properties, for full-refresh streams."""
    pruned = copy.deepcopy(schema)
    pruned["properties"] = {
        name: node
        for name, node in schema.get("properties", {}).items()
        if not name.startswith(CHANGE_COLUMN_PREFIX)
    }
    return pruned


def uses_time(data_type: T.DataType) -> bool:
    """Whether a schema holds a TIME column anywhere."""
    if isinstance(data_type, T.StructType):
        return any(uses_time(field.dataType) for field in data_type)
    if isinstance(data_type, T.ArrayType):
        return uses_time(data_type.elementType)
    return isinstance(data_type, T.TimeType)


def nullable_type(data_type: T.DataType) -> T.DataType:
    """The type with every nested value nullable, as Spark reads files."""
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, nullable_type(f.dataType), True) for f in data_type]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(nullable_type(data_type.elementType), True)
    return data_type
