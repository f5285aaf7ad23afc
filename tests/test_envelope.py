import json

import pytest
from messages import MALFORMED, global_state, log, record, rows, stream_state

import millrace as m
from millrace.plans.ingest import split_lines


def lines(spark, items):
    texts = [x if isinstance(x, str) else json.dumps(x) for x in items]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_shape_filter_and_kinds(spark):
    parsed = m.parse_envelope(
        lines(
            spark,
            [
                record("a", {"id": 1}),
                "  " + json.dumps(record("a", {})),
                json.dumps(record("a", {})) + " ",
                "plain text",
                "",
                log("{not a record}"),
                stream_state("a", {"x": 1}, "n"),
                global_state({"y": 1}, {}),
            ],
        )
    )
    assert rows(parsed.select("kind", "stream", "namespace", "state_kind")) == sorted(
        [
            ("RECORD", "a", None, None),
            ("LOG", None, None, None),
            ("STATE", "a", "n", "STREAM"),
            ("STATE", None, None, "GLOBAL"),
        ],
        key=repr,
    )
    assert m.records(parsed).count() == 1
    assert m.states(parsed).count() == 2


@pytest.mark.parametrize("line", MALFORMED)
def test_malformed_lines_end_the_job(spark, line):
    closed = line if line.endswith("}") else line + "}"
    with pytest.raises(Exception, match="Malformed message"):
        m.parse_envelope(lines(spark, [closed if closed.count("{") != closed.count("}") else line])).count()


def test_malformed_line_fires_whatever_is_asked_for(spark):
    parsed = m.parse_envelope(lines(spark, [record("a", {}), '{"type":"OTHER"}']))
    with pytest.raises(Exception, match="Malformed message"):
        parsed.select("namespace").count()
    with pytest.raises(Exception, match="Malformed message"):
        m.records(parsed).select("stream").collect()


def test_the_line_is_parsed_once(spark):
    parsed = m.parse_envelope(lines(spark, [record("a", {"id": 1})]))
    routed = m.route(m.records(parsed), m.Descriptor("a")).select("data")
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_route_tells_namespaces_apart(spark):
    parsed = m.parse_envelope(
        lines(spark, [record("a", {"id": 1}), record("a", {"id": 2}, "n"), record("a", {"id": 3}, "")])
    )
    ids = parsed.selectExpr("*", "variant_get(data, '$.id', 'int') AS id")
    assert rows(m.route(ids, m.Descriptor("a")).select("id")) == [(1,)]
    assert rows(m.route(ids, m.Descriptor("a", "n")).select("id")) == [(2,)]
    assert rows(m.route(ids, m.Descriptor("a", "")).select("id")) == [(3,)]


def test_unknown_streams(spark):
    parsed = m.parse_envelope(
        lines(
            spark,
            [
                record("a", {}),
                record("b", {}),
                record("b", {}),
                record("a", {}, "n"),
                stream_state("c", None),
                global_state(None, {("d", None): 1}),
            ],
        )
    )
    assert rows(m.unknown_streams(parsed, [m.Descriptor("a")])) == sorted(
        [("b", None, 2), ("a", "n", 1), ("c", None, 1)], key=repr
    )


def test_split_needs_no_shuffle(spark):
    df = split_lines(lines(spark, [record("a", {})]), [m.Descriptor("a"), m.Descriptor("b")], [0, 1])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_positions_follow_the_input(spark, tmp_path):
    for part in range(3):
        text = "".join(f'{{"n": {part * 1000 + i}}}\n' for i in range(1000))
        (tmp_path / f"part-{part}.txt").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scanned = m.scan_messages(spark, str(tmp_path))
        assert scanned.rdd.getNumPartitions() > 3
        found = scanned.orderBy("_pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [json.loads(r["value"])["n"] for r in found] == list(range(3000))


def test_reasons_of_malformed_lines(spark, write_lines):
    good = '{"type":"RECORD","record":{"stream":"a","data":{"id":1}}}'
    cases = {
        good: None,
        '{"type":"LOG","log":{}}': None,
        '{"type":"STATE","state":{"type":"LEGACY"}}': None,
        '{"type":"RECORD"': "",  # no shape of a message
        '{"type":"RECORD","record":{"stream":"a","data":{"id":1}}': "not JSON",
        "{'type':'LOG'}": "not JSON",
        good + " " + good: "two values",
        '{"type":"LOG"},"x":{"type":"LOG"}': "two values",
        '{"type":"RECORD","record":5}': "wrong shape",
        '{"type":"RECRD"}': "unknown kind",
        '{"record":{"stream":"a","data":{}}}': "unknown kind",
        '{"type":"RECORD","record":{"data":{}}}': "no stream",
        '{"type":"RECORD","record":{"stream":"a"}}': "no data",
        '{"type":"STATE","state":{"type":"STREAM","stream":{}}}': "state without a stream",
        '{"type":"STATE","state":{"type":"GLOBAL"}}': "malformed state",
        '{"type":"STATE"}': "malformed state",
        '{"type":"STATE","state":{"type":"GLOBAL","global":{"stream_states":[{"stream_state":{}}]}}}': "malformed state",
    }
    lines = m.scan_messages(spark, write_lines(list(cases)))
    found = {r.value: r.reason for r in m.judge_lines(lines).collect()}
    assert found == {line: reason for line, reason in cases.items() if reason != ""}
    bad = m.rejected_lines(lines).orderBy("line").collect()
    assert [(r.value, r.reason) for r in bad] == [(k, v) for k, v in cases.items() if v]
    assert all(r.file.endswith("input.txt") and r.block == 0 for r in bad)


def test_rejects_are_kept_and_the_rest_is_loaded(spark, warehouse, write_lines, tmp_path):
    schema = {"type": "object", "properties": {"id": {"type": "integer"}}}
    streams = [{"name": n, "json_schema": schema, "supported_sync_modes": ["incremental"]} for n in "ab"]
    good = [f'{{"type":"RECORD","record":{{"stream":"{n}","data":{{"id":{i}}}}}}}' for i in range(3) for n in "ab"]
    state = '{"type":"STATE","state":{"type":"STREAM","stream":{"stream_descriptor":{"name":"a"},"stream_state":{"at":2}}}}'
    bad = ['{"type":"RECORD","record":{"stream":"a"}}', good[0][:-1] + ',"}', '{"type":"X"}']
    path = write_lines([good[0], bad[0], *good[1:], bad[1], state, bad[2]])
    for k, wanted in enumerate((streams, streams[:1])):
        lines = path if len(wanted) == 2 else write_lines([line for line in [good[0], bad[0], state, bad[2]]], "one.txt")
        rejects = str(tmp_path / f"rejects{k}")
        base = f"{warehouse}{k}"
        m.ingest(spark, lines, base, {"type": "CATALOG", "catalog": {"streams": wanted}}, m.SyncConfig(rejects=rejects))
        kept = spark.read.parquet(rejects).orderBy("line").collect()
        assert [(r.value, r.reason) for r in kept] == list(zip(bad, ["no data", "not JSON", "unknown kind"])) if k == 0 else len(kept) == 2
        assert m.read_table(spark, base, "default.a").count() == (3 if k == 0 else 1)
        assert m.table_states(spark, base, ["default.a"]).first()["stream_state"] == '{"at":2}'
    with pytest.raises(Exception, match="no stream b"):
        m.ingest(spark, path, f"{warehouse}x", {"type": "CATALOG", "catalog": {"streams": streams[:1]}}, m.SyncConfig(rejects=str(tmp_path / "r")))
