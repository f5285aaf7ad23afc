"""Records of many columns, whose checks stand once for the columns alike, against the same records cut to few columns."""

import json

import pytest
from pyspark.errors import PySparkException

import millrace as m
from millrace.functions import checks
from millrace.operators.envelope import message_lines
from millrace.operators.load import load_records, parse_payload
from millrace.sources.messages import scan_messages

WIDTH = 90
KINDS = [
    {"type": ["null", "integer"], "description": "{i}"},
    {"type": "number"},
    {"type": ["null", "string"], "format": "date"},
    {"type": ["null", "boolean"]},
    {"type": ["null", "object"], "properties": {"a": {"type": ["null", "integer"]}, "b": {"type": "array", "items": {"type": "string"}}}},
    {"type": ["null", "string"]},
]
GOOD = [7, 1.5, "2024-02-29", True, {"a": 1, "b": ["x"]}, "it's"]
BAD = ["7", None, "2024-02-30", "true", {"a": "1", "b": ["x", 2]}, 5]


def key(i):
    return f"k '{i}" if i % 7 == 0 else f"k{i}é"


def schema():
    properties = {}
    for i in range(WIDTH):
        node = KINDS[i % len(KINDS)]
        properties[key(i)] = node | {"description": f"column {i}"}
    return {"type": "object", "properties": properties}


def record(bad=(), **more):
    return {key(i): (BAD if i in bad else GOOD)[i % len(GOOD)] for i in range(WIDTH)} | more


def frame(spark, rows):
    lines = [(i, json.dumps(row)) for i, row in enumerate(rows)]
    return spark.createDataFrame(lines, "id int, text string").selectExpr("id", "parse_json(text) AS data")


def errors(spark, rows):
    node = schema()
    found = m.validation_report(frame(spark, rows), node, m.to_struct(node))
    return [tuple(r) for r in found.select("id", "path", "rule", "message").collect()]


ROWS = [record(), record([i]) if (i := 40) else None, record(range(WIDTH)), record([0, 1, 2, 3, 4, 5]), {}, {key(0): None}, record(extra=1)]


def test_wide_reports_equal_narrow_ones(spark, monkeypatch):
    wide = errors(spark, ROWS)
    monkeypatch.setattr(checks, "WIDE", 10**6)
    assert wide == errors(spark, ROWS)
    assert {row[0] for row in wide} == {1, 2, 3, 4, 5}


def load(spark, path, rows):
    path.mkdir()
    message = lambda row: json.dumps({"type": "RECORD", "record": {"stream": "s", "emitted_at": 1, "data": row}})
    (path / "in.jsonl").write_text("\n".join(map(message, rows)) + "\n")
    node = schema()
    struct = m.to_struct(node)
    parsed = message_lines(scan_messages(spark, str(path))).select("value", "_pos", parse_payload(node, struct).alias("_parsed"))
    return load_records(parsed, node, struct)


def test_wide_records_load(spark, tmp_path):
    rows = load(spark, tmp_path / "a", [record(), record(extra=1), record() | {key(0): 8.0, key(6): None}]).collect()
    assert [r[0] for r in rows] == [7, 7, 8] and [r[6] for r in rows] == [7, 7, None]
    assert rows[0][4].b == ["x"] and str(rows[0][2]) == "2024-02-29" and rows[0][5] == "it's"


@pytest.mark.parametrize("wrong", [0, 1, 2, 3, 4, 5, 42, 85])
def test_wide_records_that_are_wrong_end_the_load(spark, tmp_path, wrong):
    with pytest.raises(PySparkException) as failure:
        load(spark, tmp_path / "a", [record(), record([wrong])]).collect()
    assert f".{key(wrong)}" in str(failure.value)


def test_wide_integers_are_checked_one_by_one(spark, tmp_path):
    node = {"type": "object", "properties": {f"c{i}": {"type": ["null", "integer"]} for i in range(80)}}
    struct = m.to_struct(node)

    def run(name, data):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "in.jsonl").write_text(json.dumps({"type": "RECORD", "record": {"stream": "s", "emitted_at": 1, "data": data}}) + "\n")
        parsed = message_lines(scan_messages(spark, str(folder))).select("value", "_pos", parse_payload(node, struct).alias("_parsed"))
        return load_records(parsed, node, struct).collect()[0]

    assert list(run("good", {f"c{i}": i for i in range(0, 80, 2)}))[:4] == [0, None, 2, None]
    for name, value in {"range": 2**31, "part": 1.5, "text": "1"}.items():
        with pytest.raises(PySparkException, match="c79"):
            run(name, {"c1": 1, "c79": value})
