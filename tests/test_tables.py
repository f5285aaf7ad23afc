import datetime
import glob
import os

import pytest
from messages import rows
from pyspark.sql import types as T

import millrace as m
from millrace.functions.transforms import parse_transform
from millrace.session import create_file
from millrace.sources.tables import table_path

STRUCT = T.StructType().add("id", T.IntegerType(), False).add("name", T.StringType())


def frame(spark, *values):
    return spark.createDataFrame(list(values), "id int, name string")


def test_append_overwrite_and_history(spark, warehouse):
    assert m.create_table(spark, warehouse, "n.t", STRUCT)
    assert m.read_table(spark, warehouse, "n.t").count() == 0
    m.append(frame(spark, (1, "a"), (2, None)), warehouse, "n.t")
    m.append(frame(spark, (3, "c")), warehouse, "n.t")
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(1, "a"), (2, None), (3, "c")]
    m.overwrite(frame(spark, (9, "z")), warehouse, "n.t")
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(9, "z")]
    history = m.table_history(spark, warehouse, "n.t").orderBy("seq")
    assert [(r["seq"], r["mode"], r["added_rows"]) for r in history.collect()] == [
        (1, "create", 0), (2, "append", 2), (3, "append", 1), (4, "overwrite", 1),
    ]


def test_create_leaves_an_existing_table_alone(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT)
    m.append(frame(spark, (1, "a")), warehouse, "n.t")
    assert not m.create_table(spark, warehouse, "n.t", T.StructType().add("x", T.StringType()))
    assert m.read_table(spark, warehouse, "n.t").columns == ["id", "name"]


def test_no_rows_no_commit_and_no_files(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT)
    m.append(frame(spark, (1, "a")), warehouse, "n.t")
    assert m.overwrite(frame(spark, (1, "a")).limit(0), warehouse, "n.t", stream_state="{}") is None
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(1, "a")]
    assert len(os.listdir(f"{table_path(warehouse, 'n.t')}/data")) == 1
    assert m.table_states(spark, warehouse, ["n.t"]).first()["stream_state"] is None


def test_missing_table_branch_and_values(spark, warehouse):
    with pytest.raises(LookupError, match="n.t could not be found"):
        m.read_table(spark, warehouse, "n.t")
    m.create_table(spark, warehouse, "n.t", STRUCT)
    with pytest.raises(LookupError, match="side"):
        m.read_table(spark, warehouse, "n.t", branch="side")
    with pytest.raises(ValueError):
        m.read_table(spark, warehouse, "t")
    with pytest.raises(Exception, match="needs a value"):
        m.append(frame(spark, (None, "a")), warehouse, "n.t")
    assert os.listdir(f"{table_path(warehouse, 'n.t')}/data") == []


def test_files_without_a_commit_are_invisible(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT)
    m.append(frame(spark, (1, "a")), warehouse, "n.t")
    frame(spark, (2, "b")).write.parquet(f"{table_path(warehouse, 'n.t')}/data/_sync_id=lost")
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(1, "a")]


def test_a_reader_keeps_its_view_during_an_overwrite(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT)
    m.append(frame(spark, (1, "a")), warehouse, "n.t")
    before = m.read_table(spark, warehouse, "n.t")
    m.overwrite(frame(spark, (2, "b")), warehouse, "n.t")
    assert rows(before) == [(1, "a")]


def test_branches(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT)
    m.append(frame(spark, (1, "a")), warehouse, "n.t")
    m.append(frame(spark, (2, "b")), warehouse, "n.t", branch="side", stream_state='{"at":2}')
    m.append(frame(spark, (3, "c")), warehouse, "n.t")
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(1, "a"), (3, "c")]
    assert rows(m.read_table(spark, warehouse, "n.t", branch="side")) == [(1, "a"), (2, "b")]
    m.overwrite(frame(spark, (4, "d")), warehouse, "n.t", branch="side")
    m.append(frame(spark, (5, "e")), warehouse, "n.t", branch="side")
    assert rows(m.read_table(spark, warehouse, "n.t", branch="side")) == [(4, "d"), (5, "e")]
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(1, "a"), (3, "c")]
    # States belong to the table, not to a branch.
    assert m.table_states(spark, warehouse, ["n.t"]).first()["stream_state"] == '{"at":2}'


def test_odd_table_names(spark, warehouse):
    ident = m.Identifier("a/b", "t.*[x] ü=1")
    m.create_table(spark, warehouse, ident, STRUCT)
    m.append(frame(spark, (1, "a")), warehouse, ident)
    assert rows(m.read_table(spark, warehouse, ident)) == [(1, "a")]


@pytest.mark.parametrize("text", ["identity", '"identity"', "bucket[16]", '"truncate[3]"', "Void", "hour"])
def test_transform_spellings(text):
    assert parse_transform(text)[0] in text.lower()


@pytest.mark.parametrize("text", ["", "days", "bucket", "bucket[0]", "truncate[x]", "year[1]"])
def test_bad_transforms(text):
    with pytest.raises(ValueError):
        parse_transform(text)


FULL = (
    T.StructType()
    .add("i", T.IntegerType())
    .add("s", T.StringType())
    .add("d", T.DateType())
    .add("ts", T.TimestampNTZType())
    .add("a", T.ArrayType(T.IntegerType()))
)


def test_partition_values(spark, warehouse):
    stamp = datetime.datetime(2024, 11, 3, 1, 30, 15, 123456)
    df = spark.createDataFrame(
        [(-1, "ünix", stamp.date(), stamp, [1]), (1003, "", None, None, None), (None, None, None, None, None)],
        FULL,
    )
    cases = {
        ("i", "truncate[10]"): (-10, 1000, None),
        ("i", "identity"): (-1, 1003, None),
        ("s", "truncate[2]"): ("ün", "", None),
        ("d", "year"): (2024, None, None),
        ("d", "month"): (datetime.date(2024, 11, 1), None, None),
        ("d", "day"): (datetime.date(2024, 11, 3), None, None),
        ("ts", "hour"): (datetime.datetime(2024, 11, 3, 1), None, None),
        ("ts", "day"): (datetime.date(2024, 11, 3), None, None),
    }
    for i, ((column, transform), expected) in enumerate(cases.items()):
        ident = f"n.t{i}"
        m.create_table(spark, warehouse, ident, FULL, {column: transform})
        m.append(df, warehouse, ident)
        assert rows(m.read_table(spark, warehouse, ident)) == rows(df)
        found = m.read_table(spark, warehouse, ident, with_partitions=True)
        label = next(c for c in found.columns if c.startswith("_p_"))
        values = {r["i"]: r[label] for r in found.collect()}
        assert (values[-1], values[1003], values[None]) == expected, transform


def test_partition_errors(spark, warehouse):
    for column, transform, message in (
        ("nope", "identity", "There is no column nope"),
        ("i", "year", "no year"),
        ("d", "hour", "no hour"),
        ("d", "truncate[2]", "truncated"),
        ("a", "identity", "cannot be partitioned"),
    ):
        with pytest.raises(ValueError, match=message):
            m.create_table(spark, warehouse, "n.t", FULL, {column: transform})


def test_partition_filters_prune_folders(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT, {"id": "bucket[4]", "name": "identity"})
    m.append(frame(spark, *((i, "ab"[i % 2]) for i in range(100))), warehouse, "n.t")
    found = m.read_table(spark, warehouse, "n.t", with_partitions=True).where("_p_name = 'a'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_p_name" in plan
    assert found.count() == 50
    assert len(glob.glob(f"{table_path(warehouse, 'n.t')}/data/*/*/*/*.parquet")) <= 8


def test_one_hot_partition_is_split(spark, warehouse):
    """Most rows in one partition: their files are made by several tasks."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        m.create_table(spark, warehouse, "n.t", STRUCT, {"name": "identity"})
        df = spark.range(0, 200_000, 1, 8).selectExpr("cast(id as int) id", "if(id % 100 = 0, 'cold', 'hot') name")
        m.append(df, warehouse, "n.t")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    base = f"{table_path(warehouse, 'n.t')}/data/*"
    assert len(glob.glob(f"{base}/_p_name=*hot/*.parquet")) > 1
    assert m.read_table(spark, warehouse, "n.t").count() == 200_000


def test_time_and_null_columns_round_trip(spark, warehouse):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    struct = T.StructType().add("t", T.TimeType(3)).add("n", T.NullType())
    m.create_table(spark, warehouse, "n.t", struct)
    m.append(spark.sql("SELECT cast('10:11:12.5' AS time(3)) t, NULL n"), warehouse, "n.t")
    assert rows(m.read_table(spark, warehouse, "n.t")) == [(datetime.time(10, 11, 12, 500000), None)]


def test_helper_columns_keep_clear_of_the_names_of_a_table(spark, warehouse):
    df = spark.createDataFrame([(1, "q", "r", ""), (2, "s", "t", None)], "id int, _sync_id string, _P_S string, s string")
    m.create_table(spark, warehouse, "n.t", df.schema, {"s": "identity", "id": "bucket[2]"})
    m.append(df, warehouse, "n.t")
    assert rows(m.read_table(spark, warehouse, "n.t")) == rows(df)
    found = m.read_table(spark, warehouse, "n.t", with_partitions=True)
    assert found.columns == [*df.columns, "_p_s_", "_p_id_bucket"]
    assert [r.id for r in found.where("_p_s_ = ''").collect()] == [1]
    assert [r.id for r in found.where("_p_s_ IS NULL").collect()] == [2]
    plan = found.where("_p_s_ = ''")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "substring(_p_s_" in plan.split("PartitionFilters: [")[1]


def test_of_two_writers_the_second_fails(spark, warehouse):
    df = spark.createDataFrame([(1,)], "id int")
    m.create_table(spark, warehouse, "n.t", df.schema)
    from millrace.operators.sinks import commit, write_files
    from millrace.sources.tables import load_head

    head = load_head(spark, warehouse, "n.t")
    first, second = (write_files(df, warehouse, head, "main", "append") for _ in range(2))
    assert commit(spark, warehouse, first).seq == 2
    with pytest.raises(RuntimeError, match="another commit 2"):
        commit(spark, warehouse, second)
    assert m.read_table(spark, warehouse, "n.t").count() == 1
    assert commit(spark, warehouse, write_files(df, warehouse, load_head(spark, warehouse, "n.t"), "main", "append")).seq == 3
    assert not m.create_table(spark, warehouse, "n.t", df.schema)


def test_append_checks_nested_values_and_lets_null_columns_be(spark, warehouse):
    part = T.StructType([T.StructField("x", T.IntegerType(), False)])
    schema = T.StructType([
        T.StructField("id", T.IntegerType(), False), T.StructField("z", T.NullType(), False),
        T.StructField("o", part), T.StructField("l", T.ArrayType(part, False)),
    ])
    m.create_table(spark, warehouse, "n.t", schema)
    lax = "id int, z void, o struct<x:int>, l array<struct<x:int>>"
    good = [(1, None, (1,), [(2,)]), (2, None, None, None), (3, None, (1,), [])]
    m.append(spark.createDataFrame(good, lax), warehouse, "n.t")
    assert m.read_table(spark, warehouse, "n.t").count() == 3
    for bad in ((4, None, (None,), None), (4, None, None, [None]), (4, None, None, [(None,)]), (None, None, None, None)):
        with pytest.raises(Exception, match="needs a value"):
            m.append(spark.createDataFrame([bad], lax), warehouse, "n.t")
    assert m.read_table(spark, warehouse, "n.t").count() == 3


@pytest.mark.parametrize("torn", ["", '{"namespace":"n","name":"t","seq":3,"branch":"ma', "null\n"])
def test_a_torn_commit_is_replaced(spark, warehouse, torn):
    """A crash left a part of a commit's file: the table reads as before it, and the next commit takes its place."""
    m.create_table(spark, warehouse, "n.t", STRUCT)
    rows = spark.range(5).selectExpr("cast(id as int) id", "'x' name")
    m.append(rows, warehouse, "n.t")
    path = f"{table_path(warehouse, 'n.t')}/commits/{3:020d}.json"
    with open(path, "w") as file:
        file.write(torn)
    assert m.read_table(spark, warehouse, "n.t").count() == 5
    assert m.append(rows, warehouse, "n.t").seq == 3 and m.append(rows, warehouse, "n.t").seq == 4
    assert m.read_table(spark, warehouse, "n.t").count() == 15
    assert not glob.glob(f"{table_path(warehouse, 'n.t')}/commits/.*.part")


@pytest.mark.parametrize("torn", ["", '{"namespace":"n","na'])
def test_a_torn_creation_is_made_again(spark, warehouse, torn):
    folder = f"{table_path(warehouse, 'n.t')}/commits"
    os.makedirs(folder)
    with open(f"{folder}/{1:020d}.json", "w") as file:
        file.write(torn)
    with pytest.raises(LookupError):
        m.append(spark.range(0).selectExpr("cast(id as int) id", "'x' name"), warehouse, "n.t")
    assert m.create_table(spark, warehouse, "n.t", STRUCT)
    assert not m.create_table(spark, warehouse, "n.t", STRUCT)
    m.append(spark.range(2).selectExpr("cast(id as int) id", "'x' name"), warehouse, "n.t")
    assert m.read_table(spark, warehouse, "n.t").count() == 2


def test_a_whole_commit_is_never_replaced(spark, warehouse):
    m.create_table(spark, warehouse, "n.t", STRUCT)
    path = f"{table_path(warehouse, 'n.t')}/commits/{1:020d}.json"
    before = open(path).read()
    assert not create_file(spark, path, "other", lambda text: text == before) and open(path).read() == before
    assert create_file(spark, f"{path}.new", "first") and not create_file(spark, f"{path}.new", "second")
    assert open(f"{path}.new").read() == "first"
