import pytest
from pyspark.sql import types as T

import millrace as m
from millrace.functions.jsonschema import RAW_KEY


def one(node, wide=False):
    field = m.to_struct({"type": "object", "properties": {"x": node}}, wide)["x"]
    return field.dataType, field.nullable


@pytest.mark.parametrize(
    "node, expected",
    [
        ({"type": "boolean"}, (T.BooleanType(), False)),
        ({"type": "integer"}, (T.IntegerType(), False)),
        ({"type": "number"}, (T.FloatType(), False)),
        ({"type": "string"}, (T.StringType(), False)),
        ({"type": "null"}, (T.NullType(), False)),
        ({"type": ["string"]}, (T.StringType(), False)),
        ({"type": ["null", "integer"]}, (T.IntegerType(), True)),
        ({"type": ["integer", "null"]}, (T.IntegerType(), True)),
        ({"type": ["integer", "string"]}, (T.IntegerType(), True)),
        ({"type": ["null", "number", "string"]}, (T.FloatType(), True)),
        ({"type": "string", "format": "date"}, (T.DateType(), False)),
        ({"type": ["string"], "format": "date"}, (T.DateType(), False)),
        ({"type": ["null", "string"], "format": "date-time"}, (T.TimestampNTZType(), True)),
        ({"type": "string", "format": "time"}, (T.TimeType(3), False)),
        ({"type": ["string", "integer"], "format": "date"}, (T.DateType(), True)),
        ({"type": "string", "format": "uri"}, (T.StringType(), False)),
        ({}, (T.NullType(), True)),
    ],
)
def test_scalar_types(node, expected):
    assert one(node) == expected


def test_wide_numbers():
    assert one({"type": "integer"}, True) == (T.LongType(), False)
    assert one({"type": "number"}, True) == (T.DoubleType(), False)


def test_nested_types():
    node = {"type": "object", "properties": {"a": {"type": "integer"}}}
    assert one(node) == (T.StructType().add("a", T.IntegerType(), False), True)
    assert one({"type": "array", "items": {"type": ["null", "string"]}}) == (
        T.ArrayType(T.StringType(), True),
        True,
    )
    assert one({"type": "array", "items": {"type": "string"}}) == (T.ArrayType(T.StringType(), False), True)


def test_names_are_cleaned_and_the_key_is_kept():
    struct = m.to_struct({"type": "object", "properties": {' "a" ': {"type": "integer"}}})
    assert struct.names == ["a"]
    assert struct["a"].metadata[RAW_KEY] == ' "a" '


def test_declared_order():
    names = ["z", "a", "m"]
    assert m.to_struct({"properties": {n: {"type": "string"} for n in names}}).names == names


@pytest.mark.parametrize(
    "schema",
    [
        {"type": "string"},
        {"type": "object", "properties": {}},
        {"type": "object", "properties": {"a": {"type": "integer"}, "A": {"type": "integer"}}},
        {"type": "object", "properties": {"a": {"type": []}}},
        {"type": "object", "properties": {"a": {"type": "decimal"}}},
        {"type": "object", "properties": {"a": {"type": "array"}}},
    ],
)
def test_bad_schemas(schema):
    with pytest.raises(ValueError):
        m.to_struct(schema)


def test_prune_change_columns():
    schema = {
        "type": "object",
        "properties": {
            "_ab_cdc_lsn": {"type": "integer"},
            "o": {"type": "object", "properties": {"_ab_cdc_x": {"type": "string"}}},
        },
    }
    pruned = m.prune_change_columns(schema)
    assert list(pruned["properties"]) == ["o"]
    assert "_ab_cdc_x" in pruned["properties"]["o"]["properties"]
    assert "_ab_cdc_lsn" in schema["properties"]


def test_configure_catalog_modes():
    source = {
        "type": "CATALOG",
        "catalog": {
            "streams": [
                {
                    "name": n,
                    "namespace": "s",
                    "json_schema": {
                        "type": "object",
                        "properties": {"id": {"type": "integer"}, "_ab_cdc_lsn": {"type": "integer"}},
                    },
                    "supported_sync_modes": modes,
                    "default_cursor_field": ["id"],
                    "source_defined_primary_key": [["id"]],
                }
                for n, modes in (("a", ["full_refresh", "incremental"]), ("b", ["full_refresh"]), ("c", ["incremental"]))
            ]
        },
    }
    config = m.SyncConfig(
        streams={
            "a": m.StreamConfig(),
            "b": m.StreamConfig(sync_mode="incremental"),
            "s.c": m.StreamConfig(sync_mode="full_refresh", cursor_field=["other"]),
        }
    )
    a, b, c = m.configure_catalog(source, config)["streams"]
    assert (a["sync_mode"], a["destination_sync_mode"]) == ("incremental", "append")
    assert "_ab_cdc_lsn" in a["stream"]["json_schema"]["properties"]
    assert (a["cursor_field"], a["primary_key"]) == (["id"], [["id"]])
    assert (b["sync_mode"], b["destination_sync_mode"]) == ("full_refresh", "overwrite")
    assert "_ab_cdc_lsn" not in b["stream"]["json_schema"]["properties"]
    assert (c["sync_mode"], c["cursor_field"]) == ("full_refresh", ["other"])
    only = m.configure_catalog(source, m.SyncConfig(streams={"s.b": m.StreamConfig()}))
    assert [s["stream"]["name"] for s in only["streams"]] == ["b"]
    with pytest.raises(ValueError, match="no catalog"):
        m.configure_catalog({"type": "RECORD"})
