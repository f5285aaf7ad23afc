"""Keyword checks against a plain evaluator, and where they take effect."""

from __future__ import annotations

import json
import math
import re

import pytest

import millrace as m
from millrace.functions.keywords import compile_keywords
from messages import record

VALUES = [
    None, True, False, 0, 1, 1.0, 3, -4, 2.5, 1e300, 12345678901234567890, 0.1, "", "a", "abc", "10", "true", "日本", "é\\'x", [], [1], [1, 1], [1, "a", None],
    [{"a": 1}, {"a": 1}], {}, {"a": 1}, {"a": 1, "b": "x"}, {"x_n": -1, "a": {"b": [1, 2]}}, [[1], [2, 3]], {"a": None},
]
SCHEMAS = [
    True, False, {}, {"type": "integer"}, {"type": ["string", "null"]}, {"enum": [1, "a", None, True, [1], {"a": 1}]}, {"const": 2.5}, {"const": {"a": 1}},
    {"minimum": 1}, {"maximum": 2.5}, {"exclusiveMinimum": 1}, {"exclusiveMaximum": 3}, {"minimum": 1, "exclusiveMinimum": True}, {"multipleOf": 0.5},
    {"multipleOf": 3}, {"minLength": 2}, {"maxLength": 2}, {"pattern": "^[a-z]+$"}, {"pattern": "'"}, {"minItems": 1}, {"maxItems": 1}, {"uniqueItems": True},
    {"contains": {"type": "string"}}, {"items": {"type": "integer"}}, {"items": {"items": {"minimum": 2}}}, {"items": {"required": ["a"]}}, {"required": ["a", "b"]},
    {"minProperties": 1}, {"maxProperties": 1}, {"properties": {"a": {"minimum": 2}}, "additionalProperties": False}, {"additionalProperties": {"type": "string"}},
    {"patternProperties": {"^x_": {"minimum": 0}}, "properties": {"a": {}}, "additionalProperties": False}, {"properties": {"a": {"properties": {"b": {"maxItems": 1}}}}},
    {"allOf": [{"minimum": 1}, {"maximum": 2}]}, {"anyOf": [{"type": "string"}, {"minimum": 2}]}, {"oneOf": [{"minimum": 1}, {"maximum": 2}]}, {"not": {"type": "object"}},
    {"if": {"type": "integer"}, "then": {"minimum": 1}, "else": {"type": ["string", "array"]}}, {"$ref": "#/$defs/n", "$defs": {"n": {"type": "number", "maximum": 1}}},
    {"anyOf": [{"properties": {"a": {"anyOf": [{"const": 1}, {"properties": {"b": {"items": {"enum": [1]}}}}]}}, "required": ["a"]}, {"items": {"anyOf": [{"const": 1}, {"type": "null"}]}}]},
]


def kinds_of(v):
    if v is None:
        return {"null"}
    if isinstance(v, bool):
        return {"boolean"}
    if isinstance(v, (int, float)):
        # A double too large for 64 bits is a number only.
        return {"number", "integer"} if v == math.floor(v) and (isinstance(v, int) or abs(v) < 2**63) else {"number"}
    return {"string"} if isinstance(v, str) else {"array"} if isinstance(v, list) else {"object"}


def same(a, b):
    return kinds_of(a) & kinds_of(b) != set() and (a == b if not isinstance(a, (list, dict)) else json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True))


def passes(v, s, root):
    """The keywords, one by one."""
    if isinstance(s, bool):
        return s
    number, text = "number" in kinds_of(v), isinstance(v, str)
    ok = True
    if "$ref" in s:
        ok &= passes(v, root["$defs"][s["$ref"].split("/")[-1]], root)
    if "type" in s:
        ok &= bool(kinds_of(v) & set([s["type"]] if isinstance(s["type"], str) else s["type"]))
    ok &= "enum" not in s or any(same(v, o) for o in s["enum"])
    ok &= "const" not in s or same(v, s["const"])
    if number:
        strict = s.get("exclusiveMinimum") is True
        ok &= "minimum" not in s or (v > s["minimum"] if strict else v >= s["minimum"])
        ok &= "maximum" not in s or v <= s["maximum"]
        ok &= s.get("exclusiveMinimum", True) is True or v > s["exclusiveMinimum"]
        ok &= "exclusiveMaximum" not in s or v < s["exclusiveMaximum"]
        ok &= "multipleOf" not in s or abs(v / s["multipleOf"] - round(v / s["multipleOf"])) < 1e-9
    if text:
        ok &= s.get("minLength", 0) <= len(v) <= s.get("maxLength", 99)
        ok &= "pattern" not in s or re.search(s["pattern"], v) is not None
    if isinstance(v, list):
        ok &= s.get("minItems", 0) <= len(v) <= s.get("maxItems", 99)
        ok &= not s.get("uniqueItems") or len({json.dumps(e) for e in v}) == len(v)
        ok &= "contains" not in s or any(passes(e, s["contains"], root) for e in v)
        ok &= all(passes(e, s.get("items", True), root) for e in v)
    if isinstance(v, dict):
        ok &= all(k in v for k in s.get("required", []))
        ok &= s.get("minProperties", 0) <= len(v) <= s.get("maxProperties", 99)
        for k, e in v.items():
            own = [s["properties"][k]] if k in s.get("properties", {}) else []
            own += [child for p, child in s.get("patternProperties", {}).items() if re.search(p, k)]
            ok &= all(passes(e, child, root) for child in own or [s.get("additionalProperties", True)])
    ok &= all(passes(v, p, root) for p in s.get("allOf", []))
    ok &= "anyOf" not in s or any(passes(v, p, root) for p in s["anyOf"])
    ok &= "oneOf" not in s or sum(passes(v, p, root) for p in s["oneOf"]) == 1
    ok &= "not" not in s or not passes(v, s["not"], root)
    if "if" in s:
        ok &= passes(v, s["then" if passes(v, s["if"], root) else "else"], root)
    return bool(ok)


def test_every_keyword_against_a_plain_evaluator(spark):
    """All schemas on all values, as the value of a property; the condition and the errors agree."""
    df = spark.createDataFrame([(i, json.dumps({"v": v}, ensure_ascii=False)) for i, v in enumerate(VALUES)], "i int, j string").selectExpr("i", "parse_json(j) data")
    columns = []
    for n, s in enumerate(SCHEMAS):
        root = {"properties": {"v": {"allOf": [s]}}, "$defs": s.get("$defs", {}) if isinstance(s, dict) else {}}
        good, errors = compile_keywords(root)
        columns += [f"{good} AS g{n}", f"size({errors}) AS e{n}"]
    for row in df.selectExpr("i", *columns).collect():
        for n, s in enumerate(SCHEMAS):
            expected = passes(VALUES[row.i], s, s)
            assert (row[f"g{n}"], row[f"e{n}"] == 0) == (expected, expected), (VALUES[row.i], s)


@pytest.mark.parametrize(
    "schema, message",
    [
        ({"dependencies": {}}, "not supported"), ({"properties": {"a": {"x_vendor": 1}}}, "x_vendor"), ({"items": [{}]}, "list of schemas"),
        ({"$ref": "other.json"}, "not local"), ({"$ref": "#/$defs/q"}, "nowhere"), ({"minimum": "1"}, "needs a number"), ({"enum": []}, "list of values"),
        ({"$ref": "#/$defs/a", "$defs": {"a": {"properties": {"n": {"$ref": "#/$defs/a"}}}}}, "leads to itself"),
    ],
)
def test_what_is_not_supported_is_an_error(schema, message):
    with pytest.raises(ValueError, match=re.escape(message)):
        compile_keywords(schema)
    assert compile_keywords({"x_vendor": 1}, ("x_vendor",))[0] == "true"


STRICT = {
    "type": "object",
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "size": {"type": ["null", "string"], "enum": ["S", "M", None]},
        "code": {"type": "string", "pattern": "^[A-Z]+$"},
    },
}


@pytest.mark.parametrize("streams", [1, 2])
def test_a_load_may_check_keywords(spark, warehouse, write_lines, streams):
    names = ["a", "b"][:streams]
    source = {"type": "CATALOG", "catalog": {"streams": [{"name": n, "json_schema": STRICT, "supported_sync_modes": ["incremental"]} for n in names]}}
    good = [record("a", {"id": i, "size": "S", "code": "OK"}) for i in (1, 2)] + [record("a", {"id": 3.0, "code": "X", "size": None})]
    bad = record("a", {"id": 0, "size": "L", "code": "no", "more": 1})
    lax, strict = m.SyncConfig(), m.SyncConfig(check_keywords=True)
    m.ingest(spark, write_lines(good, "good.txt"), warehouse, source, strict)
    assert m.read_table(spark, warehouse, "default.a").count() == 3
    m.ingest(spark, write_lines([bad], "bad.txt"), warehouse, source, lax)
    assert m.read_table(spark, warehouse, "default.a").count() == 4
    with pytest.raises(Exception, match="0 is below 1 at .*id"):
        m.ingest(spark, write_lines([*good, bad], "both.txt"), warehouse, source, strict)
    assert m.read_table(spark, warehouse, "default.a").count() == 4
    parsed = m.records(m.parse_envelope(m.scan_messages(spark, write_lines([*good, bad], "all.txt"))))
    found = {(r.path, r.rule) for r in m.keyword_report(parsed, STRICT).collect()}
    assert found == {("$", "additionalProperties"), ("$.id", "minimum"), ("$.size", "enum"), ("$.code", "pattern")}
    with pytest.raises(Exception, match="0 is below 1 at .*id"):
        m.validate(parsed, STRICT, keywords=True).count()
    assert m.validate(parsed, STRICT).count() == 4


def test_undeclared_fields(spark, write_lines):
    schema = {
        "type": "object",
        "properties": {
            "id": {"type": "integer"}, "o": {"type": "object", "properties": {"a": {"type": "integer"}, "free": {}}},
            "l": {"type": "array", "items": {"type": "array", "items": {"type": "object", "properties": {"a": {"type": "integer"}}}}},
        },
    }
    data = [
        {"id": 1, "new": "x", "o": {"a": 1, "b": {"c": 1}}, "l": [[{"a": 1, "z": True}, None], []]}, {"id": 2, "new": 5, "o": None, "l": None},
        {"id": 3, "o": "text", "l": [[{"z": False}], "x", [1]], "o.a": 1}, {"o": {"free": {"q": 1}, "b": {"d": "x"}}},
    ]
    parsed = m.records(m.parse_envelope(m.scan_messages(spark, write_lines([record("s", d) for d in data]))))
    got = m.undeclared_fields(parsed, schema)
    assert {(r.path, r.n, r.kind) for r in got.collect()} == {
        ("$.new", 2, "VARIANT"), ("$.o.b", 2, "OBJECT<c: BIGINT, d: STRING>"), ("$.l[][].z", 2, "BOOLEAN"), ("$.o.a", 1, "BIGINT"),
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert m.undeclared_fields(parsed.limit(0), schema).count() == 0
    # Each list of objects is made once, not again for a filter on its size, and nothing is read out of a value that was taken out.
    optimized = got._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("array<variant>") + optimized.count("ArrayType(VariantType") == 2
    assert "try_variant_get(try_variant_get(" not in optimized


def test_values_are_read_once():
    """However many checks a value has, it is read, and its kind told, once; texts of the schema stay as they are."""
    for compiled in compile_keywords({**STRICT, "properties": {**STRICT["properties"], "n": {
        "type": "integer", "minimum": 1, "maximum": 9, "multipleOf": 2, "not": {"const": 4}, "allOf": [{"exclusiveMaximum": 8}],
        "enum": [2, 6, "schema_of_variant(d)", "schema_of_variant(d)"],
    }}}, (), "d"):
        assert compiled.count("try_variant_get(d, '$[\\'n\\']', 'variant')") == 1
        read = next(x for x in compiled.split("'variant')") if "[\\'n\\']" in x).split("'x")[-1].split("'")[0]
        assert compiled.count(f"schema_of_variant(d_0.x{read})") == 1
        assert compiled.count("= 'schema_of_variant(d)'") == 2
