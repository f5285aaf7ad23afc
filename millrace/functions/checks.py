"""Checks of one record, compiled once per stream to SQL expressions.

Two sources of errors: the JSON Schema of the catalog (kinds), and the table schema that the record
has to be decoded to (required values, 32-bit range, date and time formats). Each check comes in two
forms: a cheap condition that good records pass, and the list of errors for those that do not.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import variants as V
from millrace.functions.jsonschema import is_array, is_object, raw_key, type_list

ERROR_TYPE = "struct<path:string,rule:string,message:string>"
NO_ERRORS = f"cast(array() AS array<{ERROR_TYPE}>)"
WIDE = 32  # of more fields, those alike share one expression
NOTES = {"title", "description", "default", "examples"}  # say nothing about types


def type_check(column: str, schema: dict) -> Column:
    """True when a VARIANT column is missing or has one of the types its schema node allows."""
    return F.expr(type_condition(V.name(*column.split(".")), schema))


def type_condition(value: str, schema: dict) -> str:
    kinds = type_list(schema)
    if not kinds:
        return "true"
    return "(" + " OR ".join([f"{value} IS NULL", *(V.is_kind(value, k) for k in kinds)]) + ")"


def type_ok(value: str, schema: dict, depth: int = 0) -> str:
    """Whether a value and everything below it has the types of the JSON Schema."""
    conditions = [type_condition(value, schema)]
    if is_object(schema):
        fields = _typed_fields(schema)
        if len(fields) > WIDE:
            conditions.append(_all_fields(value, fields, lambda v, _, node, d: type_ok(v, node, d), depth))
        else:
            conditions += [type_ok(V.child(value, key), node, depth) for key, node in fields]
    if is_array(schema) and type_list(schema.get("items", {})):
        x = f"x{depth}"
        inner = type_ok(x, schema["items"], depth + 1)
        conditions.append(f"coalesce(forall({V.elements(value)}, {x} -> {inner}), true)")
    return all_of(conditions)


def value_ok(value: str, data_type: T.DataType, nullable: bool, depth: int = 0) -> str:
    """Whether a value can be decoded to a column."""
    if isinstance(data_type, T.NullType):
        return "true"
    good = V.is_kind(value, json_type(data_type))
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        good += f" AND try_variant_get({value}, '$', '{data_type.simpleString()}') IS NOT NULL"
    elif V.is_format(data_type):
        good += f" AND {V.parse_format(V.text(value), data_type)} IS NOT NULL"
    elif isinstance(data_type, T.StructType):
        good += f" AND {object_ok(value, data_type, depth)}"
    elif isinstance(data_type, T.ArrayType):
        x = f"x{depth}"
        inner = value_ok(x, data_type.elementType, data_type.containsNull, depth + 1)
        good += f" AND forall({V.elements(value)}, {x} -> {inner})"
    if nullable:
        good = f"{V.is_null(value)} OR ({good})"
    return f"coalesce({good}, false)"


def object_ok(value: str, struct: T.StructType, depth: int = 0) -> str:
    if len(struct) > WIDE:
        return _all_fields(value, _columns(struct), lambda v, _, column, d: value_ok(v, *column, d), depth)
    return all_of(
        [value_ok(V.child(value, raw_key(f)), f.dataType, f.nullable, depth) for f in struct]
    )


def is_plain(field: T.StructField, node: dict | None) -> bool:
    """A scalar whose schema node allows just the type, and null only if, its column does."""
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.NullType)):
        return False
    if node is None:
        return True
    kinds = type_list(node)
    return (
        [k for k in kinds if k != "null"] == [json_type(field.dataType)]
        and ("null" in kinds) == field.nullable
    )


def all_of(conditions: list[str]) -> str:
    """True when every condition is. Unlike a chain of ANDs its generated code is split for wide rows."""
    conditions = [c for c in conditions if c != "true"]
    if not conditions:
        return "true"
    known = [c if c.startswith("coalesce(") else f"coalesce({c}, false)" for c in conditions]
    return known[0] if len(known) == 1 else f"least({', '.join(known)})"


def type_errors(value: str, schema: dict, path: str = "'$'", depth: int = 0) -> str:
    """Array of errors of a value and everything below it against the JSON Schema."""
    kinds = type_list(schema)
    if not kinds:
        return NO_ERRORS
    names = ", ".join(json.dumps(k) for k in kinds)
    label = f" is not of type {names}" if len(kinds) == 1 else f" is not of types {names}"
    message = f"concat(to_json({value}), {V.literal(label)})"
    found = [_error(f"NOT {type_condition(value, schema)}", path, "type", message)]
    nested = []
    if is_object(schema):
        fields = _typed_fields(schema)
        if len(fields) > WIDE:
            each = _each_field(value, fields, lambda v, below, node, d: type_errors(v, node, f"concat({path}, {below})", d), depth)
            nested.append(f"flatten({each})")
        else:
            nested += [type_errors(V.child(value, key), node, _below(path, key), depth) for key, node in fields]
    if is_array(schema) and type_list(schema.get("items", {})):
        inner = type_errors(f"x{depth}", schema["items"], _element(path, depth), depth + 1)
        nested.append(_each(value, inner, depth))
    return _join(found, nested)


def decode_errors(value: str, struct: T.StructType, path: str = "'$'", depth: int = 0) -> str:
    """Array of reasons why an object cannot be decoded to the columns of ``struct``."""
    if len(struct) > WIDE:
        each = _each_field(
            value, _columns(struct), lambda v, below, column, d: value_errors(v, *column, f"concat({path}, {below})", d), depth
        )
        return f"flatten({each})"
    return _join(
        [],
        [
            value_errors(
                V.child(value, raw_key(f)), f.dataType, f.nullable, _below(path, raw_key(f)), depth
            )
            for f in struct
        ],
    )


def value_errors(
    value: str, data_type: T.DataType, nullable: bool, path: str, depth: int = 0
) -> str:
    if isinstance(data_type, T.NullType):
        return NO_ERRORS
    fits = V.is_kind(value, json_type(data_type))
    shown = f"to_json({value})"
    type_name = data_type.simpleString()
    right_kind = f"NOT {V.is_null(value)} AND {fits}"
    found = [
        _error(
            f"NOT {V.is_null(value)} AND NOT {fits}",
            path,
            "type",
            f"concat({shown}, {V.literal(f' does not fit a {type_name} column')})",
        )
    ]
    nested = []
    if not nullable:
        found.append(_error(V.is_null(value), path, "required", "'a value is required'"))
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        found.append(
            _error(
                f"{right_kind} AND try_variant_get({value}, '$', '{type_name}') IS NULL",
                path,
                "range",
                f"concat({shown}, ' is outside the range of {type_name}')",
            )
        )
    elif V.is_format(data_type):
        found.append(
            _error(
                f"{right_kind} AND {V.parse_format(V.text(value), data_type)} IS NULL",
                path,
                "format",
                f"concat({shown}, ' is not a {type_name}')",
            )
        )
    elif isinstance(data_type, T.StructType):
        below = decode_errors(value, data_type, path, depth)
        nested.append(f"if({right_kind}, {below}, {NO_ERRORS})")
    elif isinstance(data_type, T.ArrayType):
        inner = value_errors(
            f"x{depth}", data_type.elementType, data_type.containsNull, _element(path, depth), depth + 1
        )
        nested.append(_each(value, inner, depth))
    return _join(found, nested)


def json_type(data_type: T.DataType) -> str:
    """The JSON Schema type a column is read from."""
    if isinstance(data_type, T.StructType):
        return "object"
    if isinstance(data_type, T.ArrayType):
        return "array"
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "number"
    return "null" if isinstance(data_type, T.NullType) else "string"


def record_errors(data: str, schema: dict, struct: T.StructType) -> str:
    """All errors of a record, one per path: kinds first, then what decoding would refuse."""
    kinds = type_errors(data, schema)
    others = decode_errors(data, struct)
    return (
        f"aggregate(concat({kinds}, {others}), {NO_ERRORS}, "
        "(found, e) -> if(exists(found, f -> f.path = e.path), found, array_append(found, e)))"
    )


def _error(bad: str, path: str, rule: str, message: str) -> str:
    return f"if({bad}, named_struct('path', {path}, 'rule', '{rule}', 'message', {message}), NULL)"


def _join(found: list[str], nested: list[str]) -> str:
    parts = [f"filter(array({', '.join(found)}), e -> e IS NOT NULL)"] if found else []
    parts += [part for part in nested if part != NO_ERRORS]
    if not parts:
        return NO_ERRORS
    return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"


def _each(value: str, inner: str, depth: int) -> str:
    """Errors of all elements of an array value; none for other kinds."""
    each = f"transform({V.elements(value)}, (x{depth}, i{depth}) -> {inner})"
    return f"coalesce(flatten({each}), {NO_ERRORS})"


def _typed_fields(schema: dict) -> list[tuple[str, dict]]:
    return [(key, node) for key, node in schema.get("properties", {}).items() if type_list(node)]


def _columns(struct: T.StructType) -> list[tuple[str, tuple]]:
    return [(raw_key(f), (f.dataType, f.nullable)) for f in struct]


def _each_field(value: str, fields: list[tuple[str, Any]], body: Callable[[str, str, Any, int], str], depth: int) -> str:
    """Array of ``body`` of each field of a wide object, in order.

    The fields are a table of constants and ``body`` stands there once for all fields alike: the time to plan a check
    grows with the kinds of columns and not with their number.
    """
    kinds, table = [], []
    for key, like in fields:
        like = {k: v for k, v in like.items() if k not in NOTES} if isinstance(like, dict) else like
        if like not in kinds:
            kinds.append(like)
        table.append({"below": f".{key}", "path": V.child_path(key), "kind": kinds.index(like)})
    k, v = f"k{depth}", f"v{depth}"
    child = f"try_variant_get({value}, {k}.path, 'variant')"
    cases = " ".join(f"WHEN {i} THEN {V.bind(child, v, body(v, f'{k}.below', like, depth + 1))}" for i, like in enumerate(kinds))
    rows = f"from_json({V.literal(json.dumps(table))}, 'array<struct<below:string,path:string,kind:int>>')"
    return f"transform({rows}, {k} -> CASE {k}.kind {cases} END)"


def _all_fields(value: str, fields: list[tuple[str, Any]], body: Callable[[str, str, Any, int], str], depth: int) -> str:
    return f"coalesce(forall({_each_field(value, fields, body, depth)}, ok{depth} -> coalesce(ok{depth}, false)), false)"


def _below(path: str, key: str) -> str:
    return f"concat({path}, {V.literal('.' + key)})"


def _element(path: str, depth: int) -> str:
    return f"concat({path}, '[', i{depth}, ']')"
