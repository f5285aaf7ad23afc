"""Whole syncs: fixtures of our own with the shapes of real sources."""

import json
import os

import pytest
from messages import MALFORMED, catalog, global_state, log, record, rows, stream, stream_state

import millrace as m
from millrace.operators.state import resolve_states
from millrace.sources.tables import table_path

ID = {"id": {"type": "integer"}}
CHANGES = {
    "_ab_cdc_lsn": {"type": "integer"},
    "_ab_cdc_deleted_at": {"type": ["null", "string"]},
}
SHOP = catalog(
    stream("goods", {**ID, "weight": {"type": ["null", "number"]}, **CHANGES}, "shop"),
    stream("sales", {**ID, "day": {"type": "string", "format": "date"}, **CHANGES}, "shop"),
    stream("stock", {"good": {"type": "integer"}, **CHANGES}, "shop", ("full_refresh",)),
)


def shop_input(first, lsn):
    change = {"_ab_cdc_lsn": lsn, "_ab_cdc_deleted_at": None}
    shared = {"state": {"z": f'{{"lsn":{lsn}}}', "a": 1.50}}
    parts = {
        ("goods", "shop"): {"stream_name": "goods", "cursor_field": []},
        ("sales", "shop"): {"stream_name": "sales", "cursor_field": [], "at": lsn},
        ("stock", "shop"): {"stream_name": "stock"},
        ("elsewhere", None): {"x": 1},
    }
    return (
        [record("goods", {"id": first + i, "weight": 0.5, **change}, "shop") for i in range(5)]
        + [record("sales", {"id": first + i, "day": "2031-07-05", **change}, "shop") for i in range(2)]
        + [global_state(shared, parts), log("half way")]
        # The state above comes before these records, and their table gets it all the same.
        + [record("stock", {"good": first + i}, "shop") for i in range(3)]
        + ["not a message"]
    )


def test_two_syncs_of_a_change_source(spark, warehouse, write_lines):
    commits = m.ingest(spark, write_lines(shop_input(0, 100)), warehouse, SHOP)
    assert {(str(c.ident), c.mode, c.added_rows) for c in commits} == {
        ("shop.goods", "append", 5), ("shop.sales", "append", 2), ("shop.stock", "overwrite", 3),
    }
    history = m.table_history(spark, warehouse, "shop.sales").orderBy("seq").collect()
    assert history[-1]["shared_state"] == '{"state":{"a":1.5,"z":"{\\"lsn\\":100}"}}'
    assert history[-1]["stream_state"] == '{"at":100,"cursor_field":[],"stream_name":"sales"}'
    m.ingest(spark, write_lines(shop_input(10, 200), "second.txt"), warehouse, SHOP)
    counts = {n: m.read_table(spark, warehouse, f"shop.{n}").count() for n in ("goods", "sales", "stock")}
    assert counts == {"goods": 10, "sales": 4, "stock": 3}
    assert rows(m.read_table(spark, warehouse, "shop.stock")) == [(10,), (11,), (12,)]
    assert m.read_table(spark, warehouse, "shop.goods").columns == [
        "id", "weight", "_ab_cdc_lsn", "_ab_cdc_deleted_at",
    ]
    (message,) = m.generate_state(spark, warehouse, SHOP)
    assert message["type"] == "GLOBAL"
    assert message["global"]["shared_state"] == {"state": {"z": '{"lsn":200}', "a": 1.5}}
    states = message["global"]["stream_states"]
    assert [s["stream_descriptor"]["name"] for s in states] == ["goods", "sales", "stock"]
    assert states[1]["stream_state"]["at"] == 200
    assert os.listdir(f"{warehouse}/.staging") == []


FILE_SOURCE = catalog(
    stream("test", {"id": {"type": ["null", "integer"]}, "at": {"type": "string", "format": "date-time"}})
)


def test_one_stream_without_namespace(spark, warehouse, write_lines):
    lines = (
        [log("start")]
        + [record("test", {"id": i, "at": "2033-02-03T04:05:06Z"}) for i in range(4)]
        + [stream_state("test", {"b": 1})]
        + [record("test", {"id": i, "at": "2033-02-03T04:05:06Z"}) for i in range(4)]
        + [stream_state("test", {"files": {"batch 7": ["ö.txt"]}, "at": "x"})]
        + [log("end")]
    )
    path = write_lines(lines)
    m.ingest(spark, path, warehouse, FILE_SOURCE)
    assert m.read_table(spark, warehouse, "default.test").count() == 8
    assert m.generate_state(spark, warehouse, FILE_SOURCE) == [
        {
            "type": "STREAM",
            "stream": {
                "stream_descriptor": {"name": "test", "namespace": "default"},
                "stream_state": {"at": "x", "files": {"batch 7": ["ö.txt"]}},
            },
        }
    ]
    state = m.table_history(spark, warehouse, "default.test").orderBy("seq").collect()[-1]["stream_state"]
    assert state == '{"at":"x","files":{"batch 7":["ö.txt"]}}'


def test_states_stay_where_a_sync_has_none(spark, warehouse, write_lines):
    source = catalog(stream("a", ID), stream("b", ID))
    first = [record("a", {"id": 1}), record("b", {"id": 1}), stream_state("a", {"n": 1}), stream_state("b", {"n": 1})]
    second = [record("a", {"id": 2}), record("b", {"id": 2}), stream_state("a", {"n": 2}), stream_state("a", None)]
    m.ingest(spark, write_lines(first, "1.txt"), warehouse, source)
    m.ingest(spark, write_lines(second, "2.txt"), warehouse, source)
    found = {s["stream"]["stream_descriptor"]["name"]: s["stream"]["stream_state"] for s in m.generate_state(spark, warehouse, source)}
    assert found == {"a": {"n": 1}, "b": {"n": 1}}


def test_state_precedence():
    a, b, c, d = (m.Descriptor(n) for n in "abcd")
    line = json.dumps(global_state({"s": 1}, {("a", None): {"g": 1}, ("b", None): {"g": 2}, ("d", "n"): 1}))
    own = {
        a: json.dumps(stream_state("a", {"own": 1})),
        b: json.dumps(stream_state("b", None)),
    }
    found = resolve_states(line, own, [a, b, c, d])
    assert {k.name: v.stream_state for k, v in found.items()} == {
        "a": '{"own":1}', "b": '{"g":2}', "c": None, "d": None,
    }
    assert {v.shared_state for v in found.values()} == {'{"s":1}'}
    twice = json.dumps({"state": {"global": {"stream_states": [
        {"stream_descriptor": {"name": "a"}, "stream_state": 1},
        {"stream_descriptor": {"name": "a"}, "stream_state": 2},
    ]}}})
    assert resolve_states(twice, {}, [a])[a].stream_state == "1"
    assert resolve_states(None, {}, [a])[a].shared_state is None


def test_last_states_over_several_files(spark, tmp_path):
    for part in range(4):
        lines = [stream_state(s, {"n": part * 10 + i}) for i in range(10) for s in "ab"]
        lines += [global_state({"n": part}, {})]
        (tmp_path / f"part-{part}.txt").write_text("\n".join(map(json.dumps, lines)) + "\n")
    parsed = m.states(m.parse_envelope(m.scan_messages(spark, str(tmp_path))))
    last = {r["stream"]: json.loads(r["line"]) for r in m.last_stream_states(parsed).collect()}
    assert {k: v["state"]["stream"]["stream_state"]["n"] for k, v in last.items()} == {"a": 39, "b": 39}
    line = json.loads(m.last_global_state(parsed).first()["line"])
    assert line["state"]["global"]["shared_state"] == {"n": 3}


TWO = catalog(stream("a", ID), stream("b", ID))


@pytest.mark.parametrize(
    "source, bad, message",
    [
        (TWO, record("b", {"id": "x"}), "is not of type"),
        (TWO, record("c", {"id": 1}), "no stream c"),
        (TWO, record("a", {"id": 1}, "n"), "no stream a"),
        (TWO, stream_state("c", {}), "no stream c"),
        (TWO, '{"type":"RECORD"}', "Malformed"),
        (TWO, record("b", {}), "a value is required"),
        (catalog(stream("a", ID)), record("c", {"id": 1}), "no stream c"),
        (catalog(stream("a", ID)), record("c", {"id": "x"}), "no stream c"),
        (catalog(stream("a", ID)), stream_state("c", {}), "no stream c"),
        (catalog(stream("a", ID)), record("a", {"id": 1.5}), "is not of type"),
        (catalog(stream("a", ID)), '{"type":"RECORD","record":{"stream":"a"}}', "Malformed"),
        (catalog(stream("a", ID)), '{"type":"LOG"} {"type":"LOG"}', "Malformed"),
        (catalog(stream("a", ID)), '{"type":"STATE","state":{"type":"GLOBAL"}}', "Malformed message"),
        (TWO, '{"type":"STATE","state":{"type":"GLOBAL"}}', "Malformed message"),
    ],
)
def test_a_failure_commits_nothing(spark, warehouse, write_lines, source, bad, message):
    lines = [record("a", {"id": i}) for i in range(3)] + [bad]
    with pytest.raises(Exception, match=message):
        m.ingest(spark, write_lines(lines), warehouse, source)
    for name in [s["name"] for s in source["catalog"]["streams"]]:
        assert m.read_table(spark, warehouse, f"default.{name}").count() == 0
        data = f"{table_path(warehouse, f'default.{name}')}/data"
        assert not os.path.exists(data) or os.listdir(data) == []


def test_append_dedup_is_refused_before_anything_is_made(spark, warehouse, write_lines):
    configured = m.configure_catalog(TWO)
    configured["streams"][1]["destination_sync_mode"] = "append_dedup"
    with pytest.raises(ValueError, match="append_dedup"):
        m.ingest(spark, write_lines([record("a", {"id": 1})]), warehouse, configured)
    assert not os.path.exists(warehouse)


def test_empty_overwrite_keeps_rows_and_state(spark, warehouse, write_lines):
    source = catalog(stream("a", ID, modes=("full_refresh",)), stream("b", ID))
    m.ingest(spark, write_lines([record("a", {"id": 1}), stream_state("a", {"n": 1})], "1.txt"), warehouse, source)
    commits = m.ingest(
        spark, write_lines([record("b", {"id": 1}), stream_state("a", {"n": 2})], "2.txt"), warehouse, source
    )
    assert [str(c.ident) for c in commits] == ["default.b"]
    assert m.read_table(spark, warehouse, "default.a").count() == 1
    (message,) = m.generate_state(spark, warehouse, source)
    assert message["stream"]["stream_state"] == {"n": 1}


def test_selected_streams_only(spark, warehouse, write_lines):
    lines = [record("a", {"id": 1}), record("b", {"id": "not checked"}), stream_state("b", {})]
    config = m.SyncConfig(streams={"a": m.StreamConfig()}, namespace="lake")
    commits = m.ingest(spark, write_lines(lines), warehouse, TWO, config)
    assert [str(c.ident) for c in commits] == ["lake.a"]
    assert os.listdir(f"{warehouse}/lake") == ["a"]
    with pytest.raises(Exception, match="no stream c"):
        m.ingest(spark, write_lines(lines + [record("c", {})]), warehouse, TWO, config)


def test_two_streams_of_one_table_are_refused(spark, warehouse, write_lines):
    source = catalog(stream("a", ID, "x"), stream("a", ID, "y"))
    with pytest.raises(ValueError, match="Two streams"):
        m.ingest(spark, write_lines([]), warehouse, source, m.SyncConfig(namespace="n"))
    m.ingest(spark, write_lines([record("a", {"id": 1}, "x"), record("a", {"id": 2}, "y")]), warehouse, source)
    assert rows(m.read_table(spark, warehouse, "x.a")) == [(1,)]


def test_an_existing_table_keeps_its_columns(spark, warehouse, write_lines):
    m.ingest(spark, write_lines([record("a", {"id": 1})], "1.txt"), warehouse, catalog(stream("a", ID)))
    wider = catalog(stream("a", {**ID, "new": {"type": ["null", "string"]}}))
    m.ingest(spark, write_lines([record("a", {"id": 2, "new": "x"})], "2.txt"), warehouse, wider)
    assert rows(m.read_table(spark, warehouse, "default.a")) == [(1,), (2,)]


def test_partitioned_branch_sync(spark, warehouse, write_lines):
    config = m.SyncConfig(
        branch="audit", streams={"default.a": m.StreamConfig(partition_by={"id": '"truncate[10]"'}), "b": m.StreamConfig()}
    )
    lines = [record("a", {"id": i}) for i in range(25)] + [record("b", {"id": 1})]
    m.ingest(spark, write_lines(lines), warehouse, TWO, config)
    assert m.read_table(spark, warehouse, "default.a").count() == 0
    found = m.read_table(spark, warehouse, "default.a", branch="audit", with_partitions=True)
    assert rows(found.groupBy("_p_id_truncate").count()) == [(0, 10), (10, 10), (20, 5)]


def test_create_tables_alone(spark, warehouse):
    assert m.create_tables(spark, warehouse, TWO) == {"default.a": True, "default.b": True}
    assert m.create_tables(spark, warehouse, TWO) == {"default.a": False, "default.b": False}
    assert m.generate_state(spark, warehouse, TWO) == []
    with pytest.raises(LookupError):
        m.generate_state(spark, warehouse, catalog(stream("c", ID)))


def test_a_replayed_batch_is_skipped_per_table(spark, warehouse, write_lines):
    lines = [record("a", {"id": 1}), record("b", {"id": 1})]
    path = write_lines(lines)
    only_a = m.SyncConfig(streams={"a": m.StreamConfig()})
    assert len(m.ingest(spark, path, warehouse, TWO, only_a, batch_key="q#0")) == 1
    commits = m.ingest(spark, path, warehouse, TWO, batch_key="q#0")
    assert [str(c.ident) for c in commits] == ["default.b"]
    assert m.ingest(spark, path, warehouse, TWO, batch_key="q#0") == []
    assert len(m.ingest(spark, path, warehouse, TWO, batch_key="q#1")) == 2


def test_streaming_takes_each_file_once(spark, warehouse, write_lines, tmp_path):
    def run():
        query = m.ingest_stream(
            spark, str(tmp_path / "in"), warehouse, TWO, str(tmp_path / "checkpoint"), max_files_per_trigger=1
        )
        query.awaitTermination()

    write_lines([record("a", {"id": 1}), stream_state("a", {"n": 1})], "1.txt")
    write_lines([record("a", {"id": 2}), record("b", {"id": 1})], "2.txt")
    run()
    run()
    write_lines([record("a", {"id": 3}), stream_state("a", {"n": 3})], "3.txt")
    run()
    assert rows(m.read_table(spark, warehouse, "default.a")) == [(1,), (2,), (3,)]
    assert rows(m.read_table(spark, warehouse, "default.b")) == [(1,)]
    (message,) = m.generate_state(spark, warehouse, TWO)
    assert message["stream"]["stream_state"] == {"n": 3}
    keys = [r["batch_key"] for r in m.table_history(spark, warehouse, "default.a").collect()]
    assert len({k for k in keys if k}) == 3


def test_streaming_refuses_overwrite(spark, warehouse, tmp_path):
    source = catalog(stream("a", ID, modes=("full_refresh",)))
    with pytest.raises(ValueError, match="cannot be streamed"):
        m.ingest_stream(spark, str(tmp_path), warehouse, source, str(tmp_path / "c"))


def stream_all(spark, tmp_path, warehouse, source, name="checkpoint", files=1):
    m.ingest_stream(
        spark, str(tmp_path / "in"), warehouse, source, str(tmp_path / name), max_files_per_trigger=files
    ).awaitTermination()


@pytest.mark.parametrize("source", [TWO, catalog(stream("a", ID))])
@pytest.mark.parametrize("files", [1, 10])
def test_states_outlive_batches_without_records(spark, warehouse, write_lines, tmp_path, source, files):
    for i, lines in enumerate([[record("a", {"id": 1})], [stream_state("a", {"n": 5})], [global_state({"g": 1}, {})], [record("a", {"id": 2})]]):
        os.utime(write_lines(lines, f"{i}.txt"), (1000 + i, 1000 + i))
    stream_all(spark, tmp_path, warehouse, source, files=files)
    (message,) = m.generate_state(spark, warehouse, source)
    assert message["global"]["shared_state"] == {"g": 1}
    assert message["global"]["stream_states"][0]["stream_state"] == {"n": 5}
    assert rows(m.read_table(spark, warehouse, "default.a")) == [(1,), (2,)]


@pytest.mark.parametrize("files", [1, 10])
def test_states_in_order_of_arrival(spark, warehouse, write_lines, tmp_path, files):
    for at, name in ((1000, "9.txt"), (2000, "10.txt")):
        os.utime(write_lines([record("a", {"id": at}), stream_state("a", {"from": name})], name), (at, at))
    stream_all(spark, tmp_path, warehouse, catalog(stream("a", ID)), files=files)
    (message,) = m.generate_state(spark, warehouse, catalog(stream("a", ID)))
    assert message["stream"]["stream_state"] == {"from": "10.txt"}


def test_another_query_at_the_same_checkpoint_path_is_no_replay(spark, warehouse, write_lines, tmp_path):
    write_lines([record("a", {"id": 1})], "1.txt")
    stream_all(spark, tmp_path, warehouse, TWO)
    (tmp_path / "checkpoint").rename(tmp_path / "old")
    (tmp_path / "in" / "1.txt").rename(tmp_path / "gone.txt")
    write_lines([record("a", {"id": 2})], "2.txt")
    stream_all(spark, tmp_path, warehouse, TWO)
    assert rows(m.read_table(spark, warehouse, "default.a")) == [(1,), (2,)]


@pytest.mark.parametrize("source", [TWO, catalog(stream("a", {**ID, "o": {"type": "object", "properties": ID}}))])
def test_the_last_of_equal_keys_counts(spark, warehouse, write_lines, source):
    line = '{"type":"RECORD","record":{"stream":"a","data":{"id":1,"id":2,"o":{"id":3,"id":4}},"emitted_at":0}}'
    m.ingest(spark, write_lines([line]), warehouse, source)
    expected = (2, (4,)) if source is not TWO else (2,)
    assert [tuple(r) for r in m.read_table(spark, warehouse, "default.a").collect()] == [expected]
    parsed = m.records(m.parse_envelope(m.scan_messages(spark, write_lines([line], "again.txt"))))
    assert m.decode(parsed, m.to_struct({"type": "object", "properties": ID})).collect()[0].id == 2


@pytest.mark.parametrize("source", [TWO, catalog(stream("a", ID))])
@pytest.mark.parametrize("line", MALFORMED)
def test_malformed_lines_end_syncs_and_leave_nothing(spark, warehouse, write_lines, source, line):
    path = write_lines([record("a", {"id": 1}), line])
    with pytest.raises(Exception, match="Malformed message"):
        m.ingest(spark, path, warehouse, source)
    for _, folders, _ in os.walk(warehouse):
        assert not [f for f in folders if f.startswith("_sync_id=")]


def test_a_configured_catalog_and_nested_records(spark, warehouse, write_lines):
    address = {"type": "object", "properties": {"street": {"type": "string"}, "postal_code": {"type": "string"}}}
    date_time = {"type": ["null", "string"], "format": "date-time"}
    schema = {"type": "object", "properties": {"id": {"type": "number"}, "seen_at": date_time, "address": address}}
    source = {
        "streams": [{
            "stream": {"name": "people", "json_schema": schema, "supported_sync_modes": ["full_refresh", "incremental"]},
            "sync_mode": "incremental", "destination_sync_mode": "append", "cursor_field": ["seen_at"], "primary_key": [["id"]],
        }]
    }
    lines = [
        record("people", {"id": 7, "seen_at": "2031-07-05T06:07:08Z", "address": {"street": "Elm 1", "postal_code": "00100"}}),
        record("people", {"id": 8.5, "seen_at": None, "address": {"street": "Oak 2", "postal_code": ""}}),
    ]
    (done,) = m.ingest(spark, write_lines(lines), warehouse, source)
    assert done.mode == "append" and done.added_rows == 2
    found = m.read_table(spark, warehouse, "default.people").orderBy("id").collect()
    assert [(r.id, str(r.seen_at), tuple(r.address)) for r in found] == [
        (7.0, "2031-07-05 06:07:08", ("Elm 1", "00100")), (8.5, "None", ("Oak 2", ""))
    ]


@pytest.mark.parametrize("files", [1, 3])
def test_states_are_fetched_late(spark, warehouse, write_lines, files, monkeypatch):
    """Only places are observed, whatever the size of the states; the lines come from their files."""
    from millrace.plans import ingest as plan

    seen = []
    fetch = plan.fetch_state
    monkeypatch.setattr(plan, "fetch_state", lambda lines, kind, place: seen.append((kind, place)) or fetch(lines, kind, place))
    large = "x" * 1_000_000
    for k in range(files):
        lines = [record("a", {"id": k}), stream_state("a", {"at": k, "s": large}), record("a", {"id": k}), stream_state("a", {"at": 10 + k, "s": large}), record("a", {"id": -k})]
        path = write_lines(lines, f"{k}.txt")
    folder = os.path.dirname(path)
    m.ingest(spark, folder, warehouse, catalog(stream("a", ID)))
    state = json.loads(m.table_states(spark, warehouse, ["default.a"]).first()["stream_state"])
    assert state == {"at": 9 + files, "s": large} and m.read_table(spark, warehouse, "default.a").count() == 3 * files
    assert [kind for kind, _ in seen] == ["STREAM"] and len(str(seen[0][1])) < 1000
    assert seen[0][1]["file"].endswith(f"{files - 1}.txt")
    # A frame without files.
    m.ingest(spark, spark.read.text(path), f"{warehouse}2", catalog(stream("a", ID)))
    assert json.loads(m.table_states(spark, f"{warehouse}2", ["default.a"]).first()["stream_state"])["at"] == 9 + files


def test_streaming_last_states_survive_a_restart(spark, write_lines, tmp_path):
    target, checkpoint = str(tmp_path / "target"), str(tmp_path / "checkpoint")
    assert m.read_last_states(spark, target).count() == 0

    def follow(lines, name):
        folder = os.path.dirname(write_lines(lines, name))
        m.last_states_stream(spark, folder, target, checkpoint).awaitTermination()
        return {(r.state_kind, r.stream): json.loads(r.line)["state"] for r in m.read_last_states(spark, target).collect()}

    first = follow([stream_state("a", {"n": 1}), record("a", {"id": 1}), stream_state("b", {"n": 2}), stream_state("a", {"n": 3}), global_state({"g": 1}, {})], "z.txt")
    assert first["STREAM", "a"]["stream"]["stream_state"] == {"n": 3} and first["GLOBAL", None]["global"]["shared_state"] == {"g": 1}
    second = follow([stream_state("b", {"n": 9}), stream_state("c", {"n": 4}), "syncing"], "a.txt")
    assert {k[1]: v["stream"]["stream_state"]["n"] for k, v in second.items() if k[0] == "STREAM"} == {"a": 3, "b": 9, "c": 4}
    third = follow([record("a", {"id": 2})], "b.txt")
    assert third == second
    with pytest.raises(Exception, match="Malformed"):
        follow(['{"type":"STATE","state":{"type":"GLOBAL"}}'], "c.txt")
