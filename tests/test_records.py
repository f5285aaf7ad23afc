"""Checks and decode, by the API and by the load path of a sync, which have to agree."""

import datetime
import json
import random

import pytest
from messages import record

import millrace as m
from millrace.operators.envelope import message_lines
from millrace.operators.load import load_records, parse_payload

PROPERTIES = {
    "i": {"type": "integer"},
    "n": {"type": ["null", "number"]},
    "s": {"type": ["null", "string"]},
    "b": {"type": ["boolean", "null"]},
    "d": {"type": ["null", "string"], "format": "date"},
    "ts": {"type": ["null", "string"], "format": "date-time"},
    "t": {"type": ["null", "string"], "format": "time"},
    "two": {"type": ["string", "integer"]},
    "o": {
        "type": "object",
        "properties": {"x": {"type": "integer"}, "y": {"type": ["null", "string"], "format": "date"}},
    },
    "a": {"type": "array", "items": {"type": ["null", "object"], "properties": {"q": {"type": "integer"}}}},
    "l": {"type": "array", "items": {"type": "integer"}},
    "e": {},
    "z": {"type": "null"},
}
NULLABLE_Z = {k: v for k, v in PROPERTIES.items() if k != "z"}
SCHEMA = {"type": "object", "properties": NULLABLE_Z}
STRUCT = m.to_struct(SCHEMA)


def lines(spark, payloads):
    texts = [p if isinstance(p, str) else json.dumps(record("s", p)) for p in payloads]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def by_api(df, schema=SCHEMA, struct=STRUCT):
    return m.decode(m.validate(m.records(m.parse_envelope(df)), schema, struct=struct), struct)


def by_load(df, schema=SCHEMA, struct=STRUCT):
    parsed = message_lines(df).select("value", "_pos", parse_payload(schema, struct).alias("_parsed"))
    return load_records(parsed, schema, struct)


PATHS = [by_api, by_load]


@pytest.mark.parametrize("path", PATHS)
def test_good_values(spark, path):
    data = {
        "i": 7,
        "n": 0.1,
        "s": "",
        "b": False,
        "d": "2024-02-29",
        "ts": "2024-11-03T01:30:00.1234567-04:00",
        "t": "23:59:59.9999",
        "two": "x",
        "o": {"x": 1, "y": None, "unknown": [1]},
        "a": [{"q": 1}, None],
        "l": [],
        "e": {"any": "thing"},
        "extra": 1,
    }
    row = path(lines(spark, [data])).first()
    assert row["i"] == 7 and row["s"] == "" and row["b"] is False
    assert abs(row["n"] - 0.1) < 1e-7 and row["n"] != 0.1
    assert row["d"] == datetime.date(2024, 2, 29)
    assert row["ts"] == datetime.datetime(2024, 11, 3, 5, 30, 0, 123456)
    assert row["t"] == datetime.time(23, 59, 59, 999000)
    assert row["two"] == "x"
    assert row["o"]["x"] == 1 and row["o"]["y"] is None
    assert row["a"][0]["q"] == 1 and row["a"][1] is None
    assert row["l"] == [] and row["e"] is None


@pytest.mark.parametrize("path", PATHS)
def test_missing_optional_values(spark, path):
    row = path(lines(spark, [{"i": 1.0}, {"i": 1, "n": None}])).collect()
    assert all(r["i"] == 1 and all(r[c] is None for c in STRUCT.names if c != "i") for r in row)


BAD = {
    "text for integer": ({"i": "1"}, 'is not of type "integer" at $.i'),
    "fraction for integer": ({"i": 1.5}, "is not of type"),
    "integer missing": ({}, "a value is required at $.i"),
    "integer null": ({"i": None}, 'null is not of type "integer"'),
    "integer too large": ({"i": 3000000000}, "outside the range of int at $.i"),
    "text for number": ({"i": 1, "n": "1"}, "at $.n"),
    "number too large": ('{"type":"RECORD","record":{"stream":"s","data":{"i":1,"n":1e999}}}', "at $.n"),
    "number for text": ({"i": 1, "s": 5}, "at $.s"),
    "object for text": ({"i": 1, "s": {"a": 1}}, "at $.s"),
    "true for text": ({"i": 1, "s": True}, "at $.s"),
    "number for boolean": ({"i": 1, "b": 0}, "at $.b"),
    "no such date": ({"i": 1, "d": "2023-02-29"}, "is not a date at $.d"),
    "loose date": ({"i": 1, "d": "2023-2-1"}, "is not a date at $.d"),
    "number for date": ({"i": 1, "d": 20230201}, "at $.d"),
    "date for date-time": ({"i": 1, "ts": "2023-02-01"}, "at $.ts"),
    "zone name": ({"i": 1, "ts": "2023-02-01T00:00:00 Europe/Paris"}, "at $.ts"),
    "no such time": ({"i": 1, "t": "25:00:00"}, "at $.t"),
    "short time": ({"i": 1, "t": "10:00"}, "at $.t"),
    "wrong of two": ({"i": 1, "two": True}, "at $.two"),
    "second of two": ({"i": 1, "two": 5}, "at $.two"),
    "null object": ({"i": 1, "o": None}, "at $.o"),
    "text for object": ({"i": 1, "o": "x"}, "at $.o"),
    "nested missing": ({"i": 1, "o": {}}, "a value is required at $.o.x"),
    "nested kind": ({"i": 1, "o": {"x": "1"}}, "at $.o.x"),
    "nested date": ({"i": 1, "o": {"x": 1, "y": "soon"}}, "at $.o.y"),
    "object for array": ({"i": 1, "a": {"q": 1}}, "at $.a"),
    "element kind": ({"i": 1, "a": [{"q": 1}, 5]}, "at $.a[1]"),
    "element nested": ({"i": 1, "a": [{"q": 1}, {"q": None}]}, "at $.a[1].q"),
    "null element": ({"i": 1, "l": [1, None]}, "at $.l[1]"),
    "element too large": ({"i": 1, "l": [3000000000]}, "at $.l[0]"),
    "not an object": ('{"type":"RECORD","record":{"stream":"s","data":5}}', 'is not of type "object" at $'),
    "null payload": ('{"type":"RECORD","record":{"stream":"s","data":null}}', "at $"),
}


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("name", BAD)
def test_bad_values_end_the_job(spark, path, name):
    payload, message = BAD[name]
    with pytest.raises(Exception) as error:
        path(lines(spark, [{"i": 1}, payload])).collect()
    assert message in str(error.value)
    assert "in data" in str(error.value)


def test_report_lists_every_bad_record(spark):
    payloads = [payload for payload, _ in BAD.values()]
    parsed = m.records(m.parse_envelope(lines(spark, payloads + [{"i": 1}, {"i": 2.0}])))
    report = m.validation_report(parsed, SCHEMA)
    assert report.select("_pos").distinct().count() == len(payloads)
    assert {r["rule"] for r in report.select("rule").collect()} == {"type", "required", "range", "format"}


def test_report_gives_all_errors_of_a_record_once_per_path(spark):
    payload = {"i": "x", "s": 1, "o": {"x": None, "y": "?"}, "l": ["1", 2, 3000000000]}
    parsed = m.records(m.parse_envelope(lines(spark, [payload])))
    found = sorted((r["path"], r["rule"]) for r in m.validation_report(parsed, SCHEMA).collect())
    assert found == [
        ("$.i", "type"), ("$.l[0]", "type"), ("$.l[2]", "range"), ("$.o.x", "type"),
        ("$.o.y", "format"), ("$.s", "type"),
    ]


def test_both_paths_and_the_report_agree_on_random_records(spark):
    random.seed(11)
    pool = {
        "i": [1, 0, -5, 1.0, 2.5, "1", None, 2147483647, 2147483648, True],
        "n": [1, 1.5, -1e-5, "x", None, 1e300, False, [1]],
        "s": ["a", "", "12", "true", "{}", 12, None, True, {"a": 1}, []],
        "b": [True, False, None, 0, "true"],
        "d": ["2024-01-31", "2024-01-32", None, 5, "2024-1-1", ""],
        "ts": ["2024-01-01T00:00:00Z", "2024-01-01 00:00:00.5", "2024-01-01T00:00:00+0530", "x", None, 1],
        "t": ["00:00:00", "23:59:59.123456", "24:00:00", None, 3],
        "two": ["a", 1, None, True],
        "o": [{"x": 1}, {"x": "1"}, {"x": None}, {}, {"x": 2.0, "y": "2024-01-01"}, 4, None],
        "a": [[], [None], [{"q": 1}], [{"q": "1"}], [{"r": 1}], {}, "a", None],
        "l": [[1, 2], [1.0], [None], ["1"], None],
        "e": [None, 1, "x", {"y": 2}],
    }
    payloads = []
    for i in range(300):
        data = {"i": i, "two": "x"}
        for key in random.sample(sorted(pool), k=random.randint(0, 3)):
            data[key] = random.choice(pool[key])
        if random.random() < 0.1:
            data.pop("i", None)
        payloads.append(data)
    df = lines(spark, payloads).coalesce(1)
    parsed = m.records(m.parse_envelope(df))
    bad = {r["_pos"]["line"] for r in m.validation_report(parsed, SCHEMA).select("_pos").collect()}
    assert 30 < len(bad) < 270
    good = lines(spark, [p for i, p in enumerate(payloads) if i not in bad]).coalesce(1)
    assert by_load(good).collect() == by_api(good).collect()
    # A record the report names fails both paths, whatever stands next to it.
    for i in sorted(bad)[:12]:
        single = lines(spark, [payloads[i]])
        for path in PATHS:
            with pytest.raises(Exception, match="in data"):
                path(single).collect()


def test_validation_uses_the_catalog_and_decode_the_table(spark):
    """The table is older than the catalog: it lacks a column, and requires another."""
    struct = m.to_struct({"type": "object", "properties": {"i": {"type": "integer"}, "s": {"type": "string"}}})
    schema = {
        "type": "object",
        "properties": {"i": {"type": ["null", "integer"]}, "s": {"type": "string"}, "new": {"type": "integer"}},
    }
    good = lines(spark, [{"i": 1, "s": "x", "new": 2}, {"i": 2, "s": "y"}])
    for path in PATHS:
        assert path(good, schema, struct).columns == ["i", "s"]
        assert path(good, schema, struct).count() == 2
        with pytest.raises(Exception, match="new"):
            path(lines(spark, [{"i": 1, "s": "x", "new": "2"}]), schema, struct).collect()
        with pytest.raises(Exception, match="required at \\$.i"):
            path(lines(spark, [{"i": None, "s": "x"}]), schema, struct).collect()


def test_odd_names(spark):
    names = ["x.y", "a b", "it's", 'say "no"', "back`tick", "sla\\sh", "ümlaut", "_c0", "_sure", "value", "$"]
    schema = {"type": "object", "properties": {n: {"type": ["null", "string"]} for n in names}}
    struct = m.to_struct(schema)
    data = {n: f"v{i}" for i, n in enumerate(names)}
    for path in PATHS:
        row = path(lines(spark, [data]), schema, struct).first()
        assert list(row) == [f"v{i}" for i in range(len(names))]


def test_keys_are_case_sensitive(spark):
    schema = {"type": "object", "properties": {"a": {"type": ["null", "integer"]}}}
    struct = m.to_struct(schema)
    for path in PATHS:
        assert path(lines(spark, [{"A": 1}]), schema, struct).first()["a"] is None


def test_wide_numbers(spark):
    schema = {"type": "object", "properties": {"i": {"type": "integer"}, "n": {"type": "number"}}}
    struct = m.to_struct(schema, wide_numbers=True)
    for path in PATHS:
        row = path(lines(spark, [{"i": 3000000000, "n": 0.1}]), schema, struct).first()
        assert tuple(row) == (3000000000, 0.1)


def test_check_fires_when_only_counted(spark):
    df = lines(spark, [{"i": "1"}])
    with pytest.raises(Exception, match="integer"):
        m.validate(m.records(m.parse_envelope(df)), SCHEMA).select("kind").count()
    with pytest.raises(Exception, match="integer"):
        by_load(df).select("s").count()
