"""

The given tables become message lines inside Spark, go through the operator over their whole length,
and are read back. Intermediate tables lie in the folder ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import millrace as m
from millrace.session import scratch_dir

try:
    import corpus_pipeline
    from millrace.llm.queries import QUERIES as LLM_QUERIES
    from millrace.llm.queries import SQL as LLM_SQL
except ImportError:
    # The subpackage, its pipeline and the libraries that only they need are optional.
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    LLM_SQL = LLM_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

INT, INT_OR_NULL = {"type": "integer"}, {"type": ["null", "integer"]}
NUM, NUM_OR_NULL = {"type": "number"}, {"type": ["number", "null"]}
TEXT, TEXT_OR_NULL = {"type": "string"}, {"type": ["null", "string"]}
DATE = {"type": "string", "format": "date"}
DATE_TIME = {"type": "string", "format": "date-time"}
TIME = {"type": "string", "format": "time"}

SCHEMAS = {
    "region": {"r_regionkey": INT, "r_name": TEXT},
    "nation": {"n_nationkey": INT, "n_name": TEXT, "n_regionkey": INT},
    "supplier": {"s_suppkey": INT, "s_name": TEXT, "s_nationkey": INT, "s_acctbal": NUM},
    "customer": {
        "c_custkey": INT,
        "c_name": TEXT,
        "c_nationkey": INT,
        "c_acctbal": NUM_OR_NULL,
        "c_mktsegment": TEXT_OR_NULL,
    },
    "part": {
        "p_partkey": INT,
        "p_name": TEXT,
        "p_brand": TEXT,
        "p_type": TEXT,
        "p_size": INT,
        "p_retailprice": NUM,
    },
    "orders": {
        "o_orderkey": INT,
        "o_custkey": INT,
        "o_orderstatus": TEXT,
        "o_totalprice": NUM,
        "o_orderdate": DATE_TIME,
        "o_orderpriority": TEXT,
    },
    "lineitem": {
        "l_orderkey": INT,
        "l_partkey": INT,
        "l_suppkey": INT,
        "l_linenumber": INT,
        "l_quantity": NUM,
        "l_extendedprice": NUM,
        "l_discount": NUM,
        "l_tax": NUM,
        "l_returnflag": TEXT,
        "l_linestatus": TEXT,
        "l_shipdate": DATE_TIME,
    },
    "events": {
        "event_id": INT,
        "ts": DATE_TIME,
        "user_id": INT,
        "event_type": TEXT,
        "value": NUM,
        "props": TEXT,
    },
}


def obj(properties: dict) -> dict:
    return {"type": "object", "properties": properties}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(name: str, properties: dict | None = None, modes: tuple = ("full_refresh", "incremental")) -> dict:
    """A stream of a discovered catalog."""
    return {
        "name": name,
        "json_schema": obj(properties or SCHEMAS[name]),
        "supported_sync_modes": list(modes),
    }


def catalog(*streams: dict) -> dict:
    return {"type": "CATALOG", "catalog": {"streams": list(streams)}}


def full_refresh(name: str, properties: dict | None = None) -> dict:
    return catalog(stream(name, properties, ("full_refresh",)))


def loaded(df: DataFrame, name: str, properties: dict | None = None, **options) -> DataFrame:
    """Load a table as messages of one appended stream and read it back."""
    warehouse = scratch_dir(df.sparkSession)
    m.ingest(
        df.sparkSession,
        m.to_messages(df, name),
        warehouse,
        catalog(stream(name, properties)),
        m.SyncConfig(**options),
    )
    return m.read_table(df.sparkSession, warehouse, f"default.{name}")


def decoded(df: DataFrame, name: str, properties: dict, wide_numbers: bool = False) -> DataFrame:
    """Messages of a table through envelope parse, validation and decode, without a table."""
    schema = obj(properties)
    parsed = m.records(m.parse_envelope(m.to_messages(df, name)))
    checked = m.validate(m.route(parsed, m.Descriptor(name)), schema, wide_numbers)
    return m.decode(checked, m.to_struct(schema, wide_numbers))


def doubles(df: DataFrame) -> DataFrame:
    """32-bit numbers as doubles, which compare exactly."""
    wide = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.FloatType)}
    return df.withColumns(wide) if wide else df


# --- scan, envelope, routing ---------------------------------------------------------------------


def append_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message files to a table and back: scan, parse, check, decode, append, read."""
    root = scratch_dir(spark)
    m.to_messages(table(spark, sf_dir, "orders"), "orders").write.text(f"{root}/messages")
    m.ingest(spark, f"{root}/messages", f"{root}/warehouse", catalog(stream("orders")))
    return doubles(m.read_table(spark, f"{root}/warehouse", "default.orders"))


def scan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of sorted lines: each line's place comes after that of the line before."""
    root = scratch_dir(spark)
    customer = table(spark, sf_dir, "customer").orderBy("c_custkey")
    m.to_messages(customer, "customer").write.text(root)
    place = F.struct("_pos")
    key = F.get_json_object("value", "$.record.data.c_custkey").cast("long")
    return m.scan_messages(spark, root).agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct("_pos").alias("places"),
        F.min_by(key, place).alias("first_key"),
        F.max_by(key, place).alias("last_key"),
    )


def mixed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records, states, log and trace lines, and lines that are no messages."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    state = F.struct(F.col("r_regionkey").alias("cursor"))
    log = F.to_json(
        F.struct(F.lit("LOG").alias("type"), F.struct(F.col("r_name").alias("message")).alias("log"))
    )
    trace = F.to_json(
        F.struct(F.lit("TRACE").alias("type"), F.struct(F.col("n_name").alias("x")).alias("trace"))
    )
    return (
        m.to_messages(nation, "nation")
        .union(m.to_stream_states(region, state, "nation"))
        .union(m.to_global_states(region, state, F.array().cast("array<string>")))
        .union(region.select(log.alias("value")))
        .union(nation.select(trace.alias("value")))
        .union(region.select(F.concat(F.lit("syncing "), "r_name").alias("value")))
        .union(region.select(F.concat(log, F.lit(" ")).alias("value")))
    )


def message_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = m.parse_envelope(mixed_lines(spark, sf_dir))
    kind = F.concat_ws(" ", "kind", "state_kind")
    return parsed.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def records_and_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = m.parse_envelope(mixed_lines(spark, sf_dir))
    count = F.count(F.lit(1)).alias("n")
    return (
        m.records(parsed).agg(F.lit("records").alias("part"), count)
        .union(m.states(parsed).agg(F.lit("states").alias("part"), count))
    )


def three_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = [m.to_messages(table(spark, sf_dir, n), n) for n in ("region", "nation", "supplier")]
    return lines[0].union(lines[1]).union(lines[2])


def route_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of one name differ by namespace, and no namespace is one of its own."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    lines = (
        three_streams(spark, sf_dir)
        .union(m.to_messages(region, "nation", "other"))
        .union(m.to_messages(nation.limit(0), "nation", ""))
    )
    parsed = m.parse_envelope(lines)
    streams = [("region", None), ("nation", None), ("supplier", None), ("nation", "other"), ("nation", "")]
    counts = [
        m.route(parsed, m.Descriptor(name, space)).agg(
            F.lit(name).alias("stream"), F.lit(space).cast("string").alias("namespace"),
            F.count(F.lit(1)).alias("n"),
        )
        for name, space in streams
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.union(part)
    return result


def load_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sync of three streams mixed in one input."""
    warehouse = scratch_dir(spark)
    streams = catalog(stream("region"), stream("nation"), stream("supplier", None, ("full_refresh",)))
    m.ingest(spark, three_streams(spark, sf_dir), warehouse, streams)
    parts = [
        m.read_table(spark, warehouse, f"default.{name}").select(
            F.lit(name).alias("stream"), F.col(key).cast("long").alias("key"), F.col(label).alias("name")
        )
        for name, key, label in (
            ("region", "r_regionkey", "r_name"),
            ("nation", "n_nationkey", "n_name"),
            ("supplier", "s_suppkey", "s_name"),
        )
    ]
    return parts[0].union(parts[1]).union(parts[2])


def select_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = scratch_dir(spark)
    streams = catalog(stream("region"), stream("nation"), stream("supplier"))
    only = m.SyncConfig(streams={"supplier": m.StreamConfig()})
    m.ingest(spark, three_streams(spark, sf_dir), warehouse, streams, only)
    return doubles(m.read_table(spark, warehouse, "default.supplier"))


def unknown_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = m.to_messages(table(spark, sf_dir, "nation"), "nation").union(
        m.to_messages(table(spark, sf_dir, "part"), "part")
    )
    return m.unknown_streams(m.parse_envelope(lines), [m.Descriptor("nation")]).select("stream", "n")


# --- columns -------------------------------------------------------------------------------------


CHANGE_COLUMNS = {"_ab_cdc_lsn": INT, "_ab_cdc_updated_at": TEXT, "_ab_cdc_deleted_at": TEXT_OR_NULL}


def changes(spark: SparkSession, sf_dir: str, modes: tuple) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(
        "*",
        (F.col("s_suppkey") + 1000).alias("_ab_cdc_lsn"),
        F.concat(F.lit("t"), "s_suppkey").alias("_ab_cdc_updated_at"),
        F.when(F.col("s_acctbal") < 0, "gone").alias("_ab_cdc_deleted_at"),
    )
    warehouse = scratch_dir(spark)
    source = catalog(stream("supplier", {**SCHEMAS["supplier"], **CHANGE_COLUMNS}, modes))
    m.ingest(spark, m.to_messages(supplier, "supplier"), warehouse, source)
    return doubles(m.read_table(spark, warehouse, "default.supplier"))


def prune_change_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir, ("full_refresh",))


def keep_change_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir, ("full_refresh", "incremental"))


def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted and padded property names; a property the schema lacks; a name with a dot."""
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias('"key"'),
        F.col("r_name").alias(" name "),
        F.length("r_name").alias("dot.ted"),
        F.lit("x").alias("extra"),
    )
    return loaded(region, "region", {'"key"': INT, " name ": TEXT, "dot.ted": INT}).withColumnRenamed(
        "dot.ted", "dotted"
    )


# --- decode --------------------------------------------------------------------------------------


def decode_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("small", F.col("p_size") < 10)
    return doubles(decoded(part, "part", {**SCHEMAS["part"], "small": {"type": "boolean"}}))


def decode_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return loaded(orders, "orders", {"o_orderkey": INT, "o_orderdate": DATE})


def decode_date_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets are taken to UTC; no offset counts as UTC."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        local.alias("plain"),
        F.concat(local, F.lit("Z")).alias("zulu"),
        F.concat(local, F.lit("+02:00")).alias("east"),
    )
    return loaded(events, "events", {"event_id": INT, "plain": DATE_TIME, "zulu": DATE_TIME, "east": DATE_TIME})


def decode_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut to milliseconds; shown as seconds and milliseconds of the day."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "HH:mm:ss.SSSSSS").alias("at")
    )
    at = F.col("at")
    second = F.extract(F.lit("SECOND"), at)
    return loaded(events, "events", {"event_id": INT, "at": TIME}).select(
        "event_id",
        F.hour(at).alias("hour"),
        F.minute(at).alias("minute"),
        F.round(second * 1000).cast("long").alias("ms"),
    )


def decode_nested_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.struct(F.col("event_type").alias("kind"), F.lit(1).alias("skipped")).alias("inner"),
        ).alias("props"),
    )
    properties = {"event_id": INT, "props": obj({"k": INT_OR_NULL, "inner": obj({"kind": TEXT})})}
    return loaded(events, "events", properties).select(
        "event_id", F.col("props.k").alias("k"), F.col("props.inner.kind").alias("kind")
    )


def decode_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    arrays = loaded(vectors, "embeddings", {"vec_id": INT, "embedding": {"type": "array", "items": NUM}})
    return arrays.select("vec_id", F.posexplode("embedding").alias("pos", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


def decode_array_of_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of objects with null elements, one array per customer."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.array(
            F.struct(F.col("c_name").alias("label"), F.col("c_nationkey").alias("n")),
            F.when(F.col("c_acctbal") >= 0, F.struct(F.lit("x").alias("label"), F.lit(0).alias("n"))),
        ).alias("items"),
    )
    item = {"type": ["null", "object"], "properties": {"label": TEXT, "n": INT}}
    rows = loaded(customer, "customer", {"c_custkey": INT, "items": {"type": "array", "items": item}})
    return rows.select("c_custkey", F.posexplode("items").alias("pos", "item")).select(
        "c_custkey", "pos", F.col("item.label").alias("label"), F.col("item.n").alias("n")
    )


def decode_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.col("c_acctbal") >= 0
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.when(known, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(known, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return doubles(loaded(customer, "customer"))


def decode_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of type null and of the empty schema are always null."""
    region = table(spark, sf_dir, "region").select("*", F.lit(None).alias("n"), F.col("r_name").alias("e"))
    rows = loaded(region, "region", {**SCHEMAS["region"], "n": {"type": "null"}, "e": {}})
    return rows.withColumns({"n": F.col("n").cast("string"), "e": F.col("e").cast("string")})


def decode_wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(table(spark, sf_dir, "lineitem"), "lineitem", wide_numbers=True)


def decode_integral_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers spelled with a fraction of zero."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return loaded(items, "lineitem", {"l_orderkey": INT, "l_linenumber": INT, "l_quantity": INT})


# --- validation ----------------------------------------------------------------------------------


def parts_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large sizes as text, cheap prices missing, and names that are numbers."""
    part = table(spark, sf_dir, "part")
    data = F.struct(
        "p_partkey",
        F.when(F.col("p_size") >= 40, F.col("p_name")).alias("p_size_text"),
        F.when(F.col("p_size") < 40, F.col("p_size")).alias("p_size"),
        F.when(F.col("p_retailprice") >= 1200, F.col("p_retailprice")).alias("p_retailprice"),
    )
    # Nulls are left out, so that each part has its size under one of two names, made one here.
    text = F.replace(F.to_json(data), F.lit("p_size_text"), F.lit("p_size"))
    return part.select(
        F.concat(
            F.lit('{"type":"RECORD","record":{"stream":"part","data":'), text, F.lit("}}")
        ).alias("value")
    )


PART_CHECKS = obj({"p_partkey": INT, "p_size": INT, "p_retailprice": NUM})


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = m.records(m.parse_envelope(parts_with_errors(spark, sf_dir)))
    return m.validation_report(parsed, PART_CHECKS).select(
        F.expr("variant_get(data, '$.p_partkey', 'int')").alias("p_partkey"), "path", "rule"
    )


def type_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each column have each JSON type."""
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value"),
        F.col("event_type"),
        (F.col("value") > 50).alias("high"),
        F.struct("user_id").alias("who"),
        F.array("user_id").alias("ids"),
        F.lit(None).cast("int").alias("nothing"),
    )
    parsed = m.parse_envelope(m.to_messages(events, "events"))
    values = parsed.select(*(F.expr(f"variant_get(data, '$.{c}', 'variant')").alias(c) for c in events.columns))
    kinds = ("null", "boolean", "integer", "number", "string", "object", "array")
    return values.agg(
        *(
            F.count_if(m.type_check(c, {"type": k})).alias(f"{c}_{k}")
            for c in events.columns
            for k in kinds
            if c != "value"
        ),
        F.count_if(m.type_check("value", {"type": "number"})).alias("value_number"),
    )


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = m.parse_envelope(m.to_messages(table(spark, sf_dir, "customer"), "customer"))
    checked = m.validate(m.records(parsed), obj(SCHEMAS["customer"]))
    return checked.select(F.expr("variant_get(data, '$.c_custkey', 'int')").alias("c_custkey"))


KEYWORDS = {
    "type": "object",
    "required": ["o_orderkey", "clerk"],
    "additionalProperties": False,
    "minProperties": 10,
    "maxProperties": 11,
    "patternProperties": {"^x_": {"type": "integer", "minimum": 0}},
    "$defs": {"price": {"type": "number", "exclusiveMinimum": 1000, "maximum": 200000.5}},
    "properties": {
        "o_orderkey": {"type": "integer", "multipleOf": 3, "minimum": 100, "exclusiveMaximum": 14000},
        "o_custkey": {
            "type": "integer",
            "anyOf": [{"maximum": 100}, {"multipleOf": 10}],
            "oneOf": [{"multipleOf": 2}, {"multipleOf": 3}],
            "not": {"const": 7},
            "allOf": [{"minimum": 5}],
            "if": {"maximum": 50},
            "then": {"multipleOf": 5},
            "else": {"multipleOf": 4},
        },
        "o_orderstatus": {"type": "string", "enum": ["F", "O"]},
        "o_totalprice": {"$ref": "#/$defs/price"},
        "o_orderpriority": {"type": "string", "pattern": "^[1-3]-", "minLength": 6, "maxLength": 10},
        "kind": {"type": "string", "const": "order"},
        "clerk": {"type": "integer"},
        "tags": {
            "type": "array",
            "minItems": 2,
            "maxItems": 3,
            "uniqueItems": True,
            "contains": {"const": "F"},
            "items": {"type": "string", "minLength": 1},
        },
        "meta": {"type": "object", "properties": {"k": {"type": "integer", "maximum": 9}}, "maxProperties": 1},
    },
}


def odd_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages with fields that come and go; nulls are left out."""
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    first = F.substring("o_orderpriority", 1, 1)
    data = F.struct(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.when(customer % 7 == 0, "x").otherwise("order").alias("kind"),
        F.when(customer % 5 != 0, customer).alias("clerk"),
        F.when(key % 4 == 0, F.array(status)).when(key % 4 == 1, F.array(status, first, status, first))
        .when(key % 4 == 2, F.array(status, F.lit(""))).otherwise(F.array(status, first)).alias("tags"),
        F.struct((key % 12).alias("k"), F.when(key % 9 == 0, first).alias("note")).alias("meta"),
        (customer % 13 - 1).alias("x_a"),
        F.when(customer % 11 == 0, F.struct((customer % 2 == 0).alias("flag"), F.lit("n").alias("text"))).alias("note"),
    )
    record = F.struct(F.lit("RECORD").alias("type"), F.struct(F.lit("orders").alias("stream"), data.alias("data")).alias("record"))
    return table(spark, sf_dir, "orders").select(F.to_json(record).alias("value"))


def keyword_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many orders violate each keyword of the schema, by path."""
    parsed = m.records(m.parse_envelope(odd_orders(spark, sf_dir)))
    return m.keyword_report(parsed, KEYWORDS).groupBy("path", "rule").agg(F.count(F.lit(1)).alias("n"))


def undeclared_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the schema's columns leave out of the orders: at the top, in an object, and objects within arrays."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") < 3, F.col("l_returnflag")).alias("flag"),
        F.struct("l_suppkey", F.struct("l_linestatus", (F.col("l_quantity") > 10).alias("many")).alias("more")).alias("part"),
        F.array(F.struct("l_partkey", "l_linenumber"), F.struct(F.lit(1).alias("l_partkey"), F.lit(None).cast("int").alias("l_linenumber"))).alias("list"),
        F.when(F.col("l_linenumber") == 1, "1").otherwise("[]").alias("mixed"),
    )
    # The mixed field is a number in some records and a list in others.
    text = F.regexp_replace(F.to_json(F.struct("*")), '"mixed":"([^"]*)"', '"mixed":$1')
    messages = lines.select(F.concat(F.lit('{"type":"RECORD","record":{"stream":"l","data":'), text, F.lit("}}")).alias("value"))
    schema = obj({
        "l_orderkey": INT, "l_linenumber": INT, "part": obj({"l_suppkey": INT, "more": obj({"l_linestatus": TEXT})}),
        "list": {"type": "array", "items": obj({"l_partkey": INT})},
    })
    return m.undeclared_fields(m.records(m.parse_envelope(messages)), schema)


def mixed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of which some are no good messages, of a kind that their key tells."""
    good = F.to_json(F.struct(F.lit("RECORD").alias("type"), F.struct(F.lit("orders").alias("stream"), F.struct("o_orderkey", "o_totalprice").alias("data")).alias("record")))
    key = F.col("o_orderkey").cast("string")
    bad = {
        1: F.concat(F.lit('{"type":"RECORD","record":{"stream":"orders","data":{"o_orderkey":'), key, F.lit("}")),
        2: F.concat(good, F.lit(" "), good),
        3: F.concat(F.lit('{"type":"RECRD","n":'), key, F.lit("}")),
        4: F.concat(F.lit('{"type":"RECORD","record":{"data":{"o_orderkey":'), key, F.lit("}}}")),
        5: F.concat(F.lit('{"type":"RECORD","record":{"stream":"orders","at":'), key, F.lit("}}")),
        6: F.concat(F.lit('{"type":"STATE","state":{"type":"STREAM","stream":{"stream_state":{"at":'), key, F.lit("}}}}")),
        7: F.concat(F.lit('{"type":"STATE","state":{"type":"GLOBAL","at":'), key, F.lit("}}")),
        8: F.concat(F.lit("reading order "), key),
    }
    line = good
    for rest, text in bad.items():
        line = F.when(F.col("o_orderkey") % 20 == rest, text).otherwise(line)
    return table(spark, sf_dir, "orders").select(line.alias("value"))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines as rows with their reason; the good ones of the same input are loaded in the same run."""
    root = scratch_dir(spark)
    mixed_orders(spark, sf_dir).write.text(f"{root}/in")
    source = catalog(stream("orders", {"o_orderkey": INT, "o_totalprice": NUM}))
    m.ingest(spark, f"{root}/in", f"{root}/warehouse", source, m.SyncConfig(rejects=f"{root}/rejects"))
    kept = spark.read.parquet(f"{root}/rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("file", "block", "line").alias("places"))
    alone = m.rejected_lines(m.scan_messages(spark, f"{root}/in")).groupBy("reason").agg(F.count(F.lit(1)).alias("alone"))
    loaded_rows = m.read_table(spark, f"{root}/warehouse", "default.orders").agg(F.lit("loaded").alias("reason"), F.count(F.lit(1)).alias("n"))
    return kept.join(alone, "reason").unionByName(loaded_rows.withColumns({"places": F.col("n"), "alone": F.col("n")}))


def checked_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A configured catalog with keywords, loaded to a table whose schema is not the stream's: columns left out, others optional."""
    part, warehouse = table(spark, sf_dir, "part"), scratch_dir(spark)
    properties = {
        "p_partkey": {"type": "integer", "minimum": 0},
        "p_name": {"type": "string", "minLength": 1},
        "p_size": {"type": "integer", "maximum": 1000},
        "box": {"type": "object", "properties": {"p_type": TEXT, "p_brand": {"type": "string", "pattern": "^Brand"}}, "required": ["p_type"]},
    }
    own = T.StructType().add("p_partkey", "long").add("box", T.StructType().add("p_type", "string")).add("absent", "string")
    m.create_table(spark, warehouse, "shop.part", own)
    entry_of = {
        "stream": {"name": "part", "namespace": "shop", "json_schema": obj(properties), "supported_sync_modes": ["full_refresh", "incremental"]},
        "sync_mode": "incremental", "destination_sync_mode": "append", "cursor_field": [], "primary_key": [["p_partkey"]],
    }
    rows = part.select("p_partkey", "p_name", "p_size", F.struct("p_type", "p_brand").alias("box"))
    m.ingest(spark, m.to_messages(rows, "part", "shop"), warehouse, {"streams": [entry_of]}, m.SyncConfig(check_keywords=True))
    return m.read_table(spark, warehouse, "shop.part").select("p_partkey", "box.p_type", "absent")


# --- tables --------------------------------------------------------------------------------------


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, warehouse = table(spark, sf_dir, "orders"), scratch_dir(spark)
    done = F.col("o_orderstatus") == "F"
    for part in (orders.where(done), orders.where(~done)):
        m.ingest(spark, m.to_messages(part, "orders"), warehouse, catalog(stream("orders")))
    return doubles(m.read_table(spark, warehouse, "default.orders"))


def overwrite_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, warehouse = table(spark, sf_dir, "nation"), scratch_dir(spark)
    for part in (nation, nation.where("n_regionkey = 1")):
        m.ingest(spark, m.to_messages(part, "nation"), warehouse, full_refresh("nation"))
    return m.read_table(spark, warehouse, "default.nation")


def overwrite_empty_keeps(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, warehouse = table(spark, sf_dir, "nation"), scratch_dir(spark)
    for part in (nation, nation.limit(0)):
        m.ingest(spark, m.to_messages(part, "nation"), warehouse, full_refresh("nation"))
    return m.read_table(spark, warehouse, "default.nation")


def sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows straight to a table: append, overwrite, append."""
    nation, warehouse = table(spark, sf_dir, "nation"), scratch_dir(spark)
    struct = m.to_struct(obj(SCHEMAS["nation"]))
    m.create_table(spark, warehouse, "default.nation", struct)
    m.append(nation, warehouse, "default.nation")
    m.overwrite(nation.where("n_regionkey < 3"), warehouse, "default.nation")
    m.append(nation.where("n_regionkey = 4"), warehouse, "default.nation")
    return m.read_table(spark, warehouse, "default.nation")


def create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating a table that exists changes nothing: neither its rows nor its columns."""
    region, warehouse = table(spark, sf_dir, "region"), scratch_dir(spark)
    m.create_table(spark, warehouse, "default.region", m.to_struct(obj(SCHEMAS["region"])))
    m.append(region, warehouse, "default.region")
    m.create_table(spark, warehouse, "default.region", m.to_struct(obj({"other": TEXT})))
    return m.read_table(spark, warehouse, "default.region")


def partitioned(spark: SparkSession, sf_dir: str, name: str, columns: list, partition_by: dict) -> DataFrame:
    warehouse = scratch_dir(spark)
    config = m.SyncConfig(streams={name: m.StreamConfig(partition_by=partition_by)})
    df = table(spark, sf_dir, name)
    m.ingest(spark, m.to_messages(df, name), warehouse, catalog(stream(name)), config)
    rows = m.read_table(spark, warehouse, f"default.{name}", with_partitions=True)
    return rows.select(*columns, *(c for c in rows.columns if c.startswith("_p_")))


def partition_by_event_time(transform: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: partitioned(spark, sf_dir, "events", ["event_id"], {"ts": transform})


def partition_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioned(spark, sf_dir, "orders", ["o_orderkey"], {"o_orderstatus": '"identity"'})


def partition_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = {"o_orderpriority": "truncate[1]", "o_custkey": "truncate[500]"}
    return partitioned(spark, sf_dir, "orders", ["o_orderkey"], by)


def partition_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = partitioned(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"], {"o_custkey": "bucket[4]"})
    bucket = F.col("_p_o_custkey_bucket")
    return rows.where(bucket.between(0, 3)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("o_custkey").alias("n_keys"),
        F.countDistinct("o_custkey", bucket).alias("n_key_buckets"),
        F.countDistinct(bucket).alias("n_buckets"),
    )


def partition_bucket_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets by the public hash: of keys, days and times."""
    rows = partitioned(spark, sf_dir, "orders", ["o_orderkey"], {"o_custkey": "bucket[16]", "o_orderdate": "bucket[7]"})
    return rows.withColumnsRenamed({"_p_o_custkey_bucket": "by_key", "_p_o_orderdate_bucket": "by_date"})


def partition_void(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioned(spark, sf_dir, "nation", ["n_nationkey"], {"n_name": "void"})


def branch_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A branch starts from what main shows; after that the two do not see each other."""
    region, warehouse = table(spark, sf_dir, "region"), scratch_dir(spark)
    low = F.col("r_regionkey") < 2
    source = catalog(stream("region"))
    m.ingest(spark, m.to_messages(region.where(low), "region"), warehouse, source)
    side = m.SyncConfig(branch="side")
    m.ingest(spark, m.to_messages(region.where(~low), "region"), warehouse, source, side)
    m.ingest(spark, m.to_messages(region, "region"), warehouse, source)
    rows = [
        m.read_table(spark, warehouse, "default.region", branch=b).select(F.lit(b).alias("branch"), "*")
        for b in ("main", "side")
    ]
    return rows[0].union(rows[1])


def commit_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, warehouse = table(spark, sf_dir, "orders"), scratch_dir(spark)
    for status in ("F", "O", "P"):
        part = orders.where(F.col("o_orderstatus") == status)
        m.ingest(spark, m.to_messages(part, "orders"), warehouse, catalog(stream("orders")))
    return m.table_history(spark, warehouse, "default.orders").select("seq", "mode", "added_rows")


# --- state ---------------------------------------------------------------------------------------


def ordered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").orderBy("ts", "event_id")


def last_global_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GLOBAL state per event, in files of ordered lines."""
    root, events = scratch_dir(spark), ordered_events(spark, sf_dir)
    none = F.array().cast("array<struct<x:int>>")
    m.to_global_states(events, F.struct("event_id"), none).write.text(root)
    last = m.last_global_state(m.states(m.parse_envelope(m.scan_messages(spark, root))))
    path = "$.state.global.shared_state.event_id"
    return last.select(F.get_json_object("line", path).cast("long").alias("event_id"))


def last_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, events = scratch_dir(spark), ordered_events(spark, sf_dir)
    m.to_stream_states(events, F.struct("event_id"), F.col("event_type")).write.text(root)
    last = m.last_stream_states(m.states(m.parse_envelope(m.scan_messages(spark, root))))
    path = "$.state.stream.stream_state.event_id"
    return last.select("stream", F.get_json_object("line", path).cast("long").alias("event_id"))


def sync_with_states(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """Events as one stream per type. A GLOBAL state gives each type its count; the types before
    "d" also send STREAM states, one per event."""
    root = scratch_dir(spark)
    events = table(spark, sf_dir, "events")
    types = [row[0] for row in events.select("event_type").distinct().orderBy("event_type").collect()]
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    part = F.struct(
        F.struct(F.col("event_type").alias("name")).alias("stream_descriptor"),
        F.struct(F.col("n").alias("at")).alias("stream_state"),
    )
    # One row per event type.
    summary = counts.agg(F.collect_list(part).alias("parts"), F.sum("n").alias("total"))
    m.to_global_states(summary, F.struct("total"), F.col("parts")).write.text(f"{root}/in/a")
    records = F.to_json(
        F.struct(
            F.lit("RECORD").alias("type"),
            F.struct(
                F.col("event_type").alias("stream"), F.struct("event_id", "user_id").alias("data")
            ).alias("record"),
        )
    )
    events.select(records.alias("value")).write.text(f"{root}/in/b")
    early = ordered_events(spark, sf_dir).where("event_type < 'd'")
    state = F.struct(F.col("event_id").alias("at"))
    m.to_stream_states(early, state, F.col("event_type")).write.text(f"{root}/in/c")
    source = catalog(*(stream(t, {"event_id": INT, "user_id": INT}) for t in types))
    paths = [f"{root}/in/{part}" for part in "abc"]
    m.ingest(spark, paths, f"{root}/warehouse", source)
    return f"{root}/warehouse", source


def resolved_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, source = sync_with_states(spark, sf_dir)
    names = [s["name"] for s in source["catalog"]["streams"]]
    states = m.table_states(spark, warehouse, [f"default.{name}" for name in names])
    return states.select(
        F.col("name").alias("stream"),
        F.get_json_object("shared_state", "$.total").cast("long").alias("total"),
        F.get_json_object("stream_state", "$.at").cast("long").alias("cursor_at"),
    )


def generate_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state message a source would get, one row per stream of it."""
    warehouse, source = sync_with_states(spark, sf_dir)
    lines = [json.dumps(message) for message in m.generate_state(spark, warehouse, source)]
    shape = (
        "type string, global struct<shared_state: struct<total: bigint>, stream_states: array<struct<"
        "stream_descriptor: struct<name: string, namespace: string>, stream_state: struct<at: bigint>>>>"
    )
    message = spark.createDataFrame([(line,) for line in lines], "line string").select(
        F.from_json("line", shape).alias("m")
    )
    return message.select(
        "m.type", "m.global.shared_state.total", F.explode("m.global.stream_states").alias("s")
    ).select(
        "type",
        "total",
        F.col("s.stream_descriptor.name").alias("stream"),
        F.col("s.stream_descriptor.namespace").alias("namespace"),
        F.col("s.stream_state.at").alias("cursor_at"),
    )


# --- streaming -----------------------------------------------------------------------------------


def streaming_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files are loaded once; a run with nothing new adds nothing."""
    root = scratch_dir(spark)
    lines = m.to_messages(table(spark, sf_dir, "events"), "events")
    source = catalog(stream("events"))
    for part in lines.randomSplit([0.5, 0.5], seed=7):
        part.write.mode("append").text(f"{root}/in")
        for _ in range(2):
            query = m.ingest_stream(
                spark, f"{root}/in", f"{root}/warehouse", source, f"{root}/checkpoint"
            )
            query.awaitTermination()
    return doubles(m.read_table(spark, f"{root}/warehouse", "default.events"))


def streaming_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States come in files of their own, after the records; the size of micro-batches makes no difference."""
    events, root, source = table(spark, sf_dir, "events"), scratch_dir(spark), catalog(stream("events"))
    for k in range(3):
        part = events.where(F.col("event_id") % 3 == k)
        m.to_messages(part, "events").coalesce(1).write.mode("append").text(f"{root}/in")
        last = part.agg(F.max("event_id").alias("event_id"), F.count(F.lit(1)).alias("n")).coalesce(1)
        m.to_stream_states(last, F.struct("event_id", "n"), "events").write.mode("append").text(f"{root}/in")
    rows = []
    for batch, files in (("one file", 1), ("all files", None)):
        warehouse = f"{root}/{files}"
        m.ingest_stream(
            spark, f"{root}/in", warehouse, source, f"{warehouse}-checkpoint", max_files_per_trigger=files
        ).awaitTermination()
        state = m.generate_state(spark, warehouse, source)[0]["stream"]["stream_state"]
        loaded_rows = m.read_table(spark, warehouse, "default.events").count()
        rows.append((state["event_id"], state["n"], loaded_rows, batch))
    return spark.createDataFrame(rows, "event_id long, n long, loaded long, batch string")


def streaming_last_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query is stopped between files and goes on from its state store; streams of later files only are added."""
    events, root = ordered_events(spark, sf_dir), scratch_dir(spark)
    for k in range(3):
        part = events.where(F.col("event_id") % 3 == k).where((F.col("event_type") != "view") | (F.col("event_id") % 3 < 2))
        m.to_stream_states(part, F.struct("event_id"), F.col("event_type")).coalesce(1).write.mode("append").text(f"{root}/in")
        m.last_states_stream(spark, f"{root}/in", f"{root}/states", f"{root}/checkpoint").awaitTermination()
    path = "$.state.stream.stream_state.event_id"
    return m.read_last_states(spark, f"{root}/states").select("stream", F.get_json_object("line", path).cast("long").alias("event_id"))


def append_null_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table may have a column of the null type."""
    warehouse = scratch_dir(spark)
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int"), "c_name", F.lit(None).alias("nothing"))
    required = T.StructType([T.StructField(f.name, f.dataType, False) for f in df.schema])
    m.create_table(spark, warehouse, "shop.customer", required)
    m.append(df, warehouse, "shop.customer")
    return m.read_table(spark, warehouse, "shop.customer").withColumn("nothing", F.col("nothing").cast("string"))


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal keys the last one counts, at the top and nested."""
    line = (
        '{"type":"RECORD","record":{"stream":"part","data":{"p_partkey":0,"p_partkey":%d,"o":{"s":-1,"s":%d}},"emitted_at":0}}'
    )
    lines = table(spark, sf_dir, "part").select(F.format_string(line, "p_partkey", "p_size").alias("value"))
    warehouse = scratch_dir(spark)
    m.ingest(spark, lines, warehouse, catalog(stream("part", {"p_partkey": INT, "o": obj({"s": INT})})))
    return m.read_table(spark, warehouse, "default.part").select("p_partkey", "o.s")


def partition_empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty text is a partition of its own, and a property may have the name of a helper column."""
    segment = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_custkey") % 10 != 0, F.col("c_mktsegment"))
    df = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("_sync_id"), segment.alias("segment"))
    warehouse = scratch_dir(spark)
    source = catalog(stream("customer", {"c_custkey": INT, "_sync_id": TEXT, "segment": TEXT_OR_NULL}))
    config = m.SyncConfig(streams={"customer": m.StreamConfig(partition_by={"segment": "identity"})})
    m.ingest(spark, m.to_messages(df, "customer"), warehouse, source, config)
    found = m.read_table(spark, warehouse, "default.customer", with_partitions=True)
    return found.where("_p_segment = ''").select("c_custkey", "_sync_id")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: orders as messages, loaded to a table and read back."""
    return append_orders(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator."""
    return core_queries() | LLM_QUERIES


def core_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The operators of the loader, all with SQL."""
    functions = [
        append_orders, scan_order, message_kinds, records_and_states, route_streams, load_streams,
        select_streams, unknown_streams, prune_change_columns, keep_change_columns, clean_names,
        decode_scalars, decode_date, decode_date_time, decode_time, decode_nested_object, decode_array,
        decode_array_of_objects, decode_optional, decode_empty, decode_wide_numbers,
        decode_integral_numbers, validation_report, type_check, validate, append_twice,
        overwrite_twice, overwrite_empty_keeps, sinks, create_table, partition_identity,
        partition_truncate, partition_bucket, partition_bucket_spec, partition_void, branch_write, commit_history,
        last_global_state, last_stream_state, resolved_state, generate_state, streaming_append,
        streaming_states, append_null_column, duplicate_keys, partition_empty_text, keyword_report, undeclared_fields,
        rejected_lines, checked_load, streaming_last_states,
    ]
    named = {f.__name__: f for f in functions}
    for transform in ("year", "month", "day", "hour"):
        named[f"partition_{transform}"] = partition_by_event_time(transform)
    return named


def real(column: str) -> str:
    """A 32-bit number as a double."""
    return f"CAST(CAST({column} AS REAL) AS DOUBLE) AS {column}"


def integer(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in columns)


ORDERS = (
    f"SELECT {integer('o_orderkey', 'o_custkey')}, o_orderstatus, {real('o_totalprice')}, o_orderdate, "
    "o_orderpriority FROM orders"
)
SUPPLIER = f"{integer('s_suppkey')}, s_name, s_nationkey, {real('s_acctbal')}"
LAST_EVENT = "arg_max(event_id, (ts, event_id))"
STATES = (
    "SELECT event_type AS stream, (SELECT count(*) FROM events) AS total, "
    f"CASE WHEN event_type < 'd' THEN {LAST_EVENT} ELSE count(*) END AS cursor_at FROM events GROUP BY event_type"
)


def event_partition(value: str, name: str) -> str:
    return f"SELECT CAST(event_id AS INTEGER) AS event_id, {value} AS _p_ts_{name} FROM events"


def murmur_sql(value: str, buckets: int) -> str:
    """Bucket of an 8-byte integer, written out step by step."""
    word = "4294967296"
    turn = lambda x, r: f"((({x}) * {1 << r}) % {word} + (({x}) // {1 << (32 - r)}))"
    wide = f"CASE WHEN {value} < 0 THEN {value}::HUGEINT + 18446744073709551616 ELSE {value}::HUGEINT END"
    steps = [("k0", f"({wide}) % {word}"), ("k1", f"({wide}) // {word}"), ("h0", "0::HUGEINT")]
    for i in (0, 1):
        steps += [(f"a{i}", f"(k{i} * {0xCC9E2D51}) % {word}"), (f"b{i}", turn(f"a{i}", 15)), (f"c{i}", f"(b{i} * {0x1B873593}) % {word}")]
        steps += [(f"d{i}", f"xor(h{i}, c{i})"), (f"e{i}", turn(f"d{i}", 13)), (f"h{i + 1}", f"(e{i} * 5 + {0xE6546B64}) % {word}")]
    steps += [("f0", "xor(h2, 8::HUGEINT)"), ("f1", "xor(f0, f0 // 65536)"), ("f2", f"(f1 * {0x85EBCA6B}) % {word}"), ("f3", "xor(f2, f2 // 8192)")]
    steps += [("f4", f"(f3 * {0xC2B2AE35}) % {word}"), ("f5", "xor(f4, f4 // 65536)")]
    inner = "SELECT 1 AS one"
    for name, expression in steps:
        inner = f"SELECT *, {expression} AS {name} FROM ({inner})"
    return f"(SELECT CAST((f5 % 2147483648) % {buckets} AS INTEGER) FROM ({inner}))"


def type_counts() -> str:
    """Every present value has one JSON type; an integer is a number too."""
    kinds = ("null", "boolean", "integer", "number", "string", "object", "array")
    fits = {
        "event_id": ("integer", "number"),
        "event_type": ("string",),
        "high": ("boolean",),
        "who": ("object",),
        "ids": ("array",),
        "nothing": ("null",),
    }
    counts = [
        f"{'count(*)' if kind in good else 'CAST(0 AS BIGINT)'} AS {column}_{kind}"
        for column, good in fits.items()
        for kind in kinds
    ]
    return f"SELECT {', '.join(counts)}, count(*) AS value_number FROM events"


def keyword_counts() -> str:
    """One row for each rule and path that some order violates."""
    k, c = "o_orderkey", "o_custkey"
    has_note, has_clerk = f"({c} % 11 = 0)", f"({c} % 5 <> 0)"
    size = f"(9 + CAST({has_clerk} AS INTEGER) + CAST({has_note} AS INTEGER))"
    rules = {
        ("$", "minProperties"): f"{size} < 10",
        ("$", "maxProperties"): f"{size} > 11",
        ("$", "additionalProperties"): has_note,
        ("$", "patternProperties"): f"{c} % 13 = 0",
        ("$.clerk", "required"): f"NOT {has_clerk}",
        ("$.o_orderkey", "multipleOf"): f"{k} % 3 <> 0",
        ("$.o_orderkey", "minimum"): f"{k} < 100",
        ("$.o_orderkey", "exclusiveMaximum"): f"{k} >= 14000",
        ("$.o_custkey", "anyOf"): f"{c} > 100 AND {c} % 10 <> 0",
        ("$.o_custkey", "oneOf"): f"({c} % 2 = 0) = ({c} % 3 = 0)",
        ("$.o_custkey", "not"): f"{c} = 7",
        ("$.o_custkey", "minimum"): f"{c} < 5",
        ("$.o_custkey", "then"): f"{c} <= 50 AND {c} % 5 <> 0",
        ("$.o_custkey", "else"): f"{c} > 50 AND {c} % 4 <> 0",
        ("$.o_orderstatus", "enum"): "o_orderstatus NOT IN ('F', 'O')",
        ("$.o_totalprice", "exclusiveMinimum"): "o_totalprice <= 1000",
        ("$.o_totalprice", "maximum"): "o_totalprice > 200000.5",
        ("$.o_orderpriority", "pattern"): "substr(o_orderpriority, 1, 2) NOT IN ('1-', '2-', '3-')",
        ("$.o_orderpriority", "minLength"): "length(o_orderpriority) < 6",
        ("$.o_orderpriority", "maxLength"): "length(o_orderpriority) > 10",
        ("$.kind", "const"): f"{c} % 7 = 0",
        ("$.tags", "minItems"): f"{k} % 4 = 0",
        ("$.tags", "maxItems"): f"{k} % 4 = 1",
        ("$.tags", "uniqueItems"): f"{k} % 4 = 1",
        ("$.tags", "contains"): "o_orderstatus <> 'F'",
        ("$.tags[1]", "minLength"): f"{k} % 4 = 2",
        ("$.meta.k", "maximum"): f"{k} % 12 > 9",
        ("$.meta", "maxProperties"): f"{k} % 9 = 0",
    }
    counts = [f"SELECT '{path}' AS path, '{rule}' AS rule, count(*) AS n FROM orders WHERE {bad}" for (path, rule), bad in rules.items()]
    return f"SELECT * FROM ({' UNION ALL '.join(counts)}) WHERE n > 0"


UNDECLARED = (
    "SELECT '$.flag' AS path, count(*) FILTER (l_linenumber < 3) AS n, 'STRING' AS kind FROM lineitem "
    "UNION ALL SELECT '$.mixed', count(*), 'VARIANT' FROM lineitem "
    "UNION ALL SELECT '$.part.more.many', count(*), 'BOOLEAN' FROM lineitem "
    "UNION ALL SELECT '$.list[].l_linenumber', count(*), 'BIGINT' FROM lineitem"
)
REASONS = {
    1: "not JSON", 2: "two values", 3: "unknown kind", 4: "no stream", 5: "no data", 6: "state without a stream", 7: "malformed state",
}


def reason_counts() -> str:
    kind = "CASE o_orderkey % 20 " + " ".join(f"WHEN {k} THEN '{reason}'" for k, reason in REASONS.items()) + " ELSE 'loaded' END"
    return f"SELECT {kind} AS reason, count(*) AS n, count(*) AS places, count(*) AS alone FROM orders WHERE o_orderkey % 20 <> 8 GROUP BY 1"


def oracle_sql() -> dict[str, str]:
    """The SQL each query has to agree with."""
    return core_sql() | LLM_SQL


def core_sql() -> dict[str, str]:
    return {
        "append_orders": ORDERS,
        "append_twice": ORDERS,
        "scan_order": "SELECT count(*) AS lines, count(*) AS places, min(c_custkey) AS first_key, "
        "max(c_custkey) AS last_key FROM customer",
        "message_kinds": "SELECT 'RECORD' AS kind, count(*) AS n FROM nation "
        "UNION ALL SELECT 'STATE STREAM', count(*) FROM region "
        "UNION ALL SELECT 'STATE GLOBAL', count(*) FROM region "
        "UNION ALL SELECT 'LOG', count(*) FROM region UNION ALL SELECT 'TRACE', count(*) FROM nation",
        "records_and_states": "SELECT 'records' AS part, count(*) AS n FROM nation "
        "UNION ALL SELECT 'states', 2 * count(*) FROM region",
        "route_streams": "SELECT 'region' AS stream, CAST(NULL AS VARCHAR) AS namespace, count(*) AS n "
        "FROM region UNION ALL SELECT 'nation', NULL, count(*) FROM nation "
        "UNION ALL SELECT 'supplier', NULL, count(*) FROM supplier "
        "UNION ALL SELECT 'nation', 'other', count(*) FROM region UNION ALL SELECT 'nation', '', 0",
        "load_streams": "SELECT 'region' AS stream, CAST(r_regionkey AS BIGINT) AS key, r_name AS name "
        "FROM region UNION ALL SELECT 'nation', n_nationkey, n_name FROM nation "
        "UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier",
        "select_streams": f"SELECT {SUPPLIER} FROM supplier",
        "unknown_streams": "SELECT 'part' AS stream, count(*) AS n FROM part",
        "prune_change_columns": f"SELECT {SUPPLIER} FROM supplier",
        "keep_change_columns": f"SELECT {SUPPLIER}, CAST(s_suppkey + 1000 AS INTEGER) AS _ab_cdc_lsn, "
        "'t' || s_suppkey AS _ab_cdc_updated_at, CASE WHEN s_acctbal < 0 THEN 'gone' END "
        "AS _ab_cdc_deleted_at FROM supplier",
        "clean_names": "SELECT r_regionkey AS key, r_name AS name, CAST(length(r_name) AS INTEGER) "
        "AS dotted FROM region",
        "decode_scalars": f"SELECT {integer('p_partkey')}, p_name, p_brand, p_type, p_size, "
        f"{real('p_retailprice')}, p_size < 10 AS small FROM part",
        "decode_date": f"SELECT {integer('o_orderkey')}, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
        "decode_date_time": f"SELECT {integer('event_id')}, ts AS plain, ts AS zulu, "
        "ts - INTERVAL 2 HOUR AS east FROM events",
        "decode_time": f"SELECT {integer('event_id')}, CAST(hour(ts) AS INTEGER) AS hour, "
        "CAST(minute(ts) AS INTEGER) AS minute, millisecond(ts) AS ms FROM events",
        "decode_nested_object": f"SELECT {integer('event_id')}, "
        "CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type AS kind FROM events",
        "decode_array": "SELECT CAST(vec_id AS INTEGER) AS vec_id, CAST(p - 1 AS INTEGER) AS pos, "
        "CAST(embedding[p] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, "
        "unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)",
        "decode_array_of_objects": f"SELECT {integer('c_custkey')}, 0 AS pos, c_name AS label, "
        "c_nationkey AS n FROM customer UNION ALL SELECT CAST(c_custkey AS INTEGER), 1, "
        "CASE WHEN c_acctbal >= 0 THEN 'x' END, CASE WHEN c_acctbal >= 0 THEN 0 END FROM customer",
        "decode_optional": f"SELECT {integer('c_custkey')}, c_name, c_nationkey, CASE WHEN c_acctbal >= 0 "
        "THEN CAST(CAST(c_acctbal AS REAL) AS DOUBLE) END AS c_acctbal, "
        "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS c_mktsegment FROM customer",
        "decode_empty": "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS n, CAST(NULL AS VARCHAR) AS e "
        "FROM region",
        "decode_wide_numbers": "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) "
        "AS l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
        "l_shipdate FROM lineitem",
        "decode_integral_numbers": f"SELECT {integer('l_orderkey', 'l_linenumber', 'l_quantity')} FROM lineitem",
        "validation_report": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, '$.p_size' AS path, "
        "'type' AS rule FROM part WHERE p_size >= 40 UNION ALL SELECT CAST(p_partkey AS INTEGER), "
        "'$.p_retailprice', 'required' FROM part WHERE p_retailprice < 1200",
        "type_check": type_counts(),
        "validate": f"SELECT {integer('c_custkey')} FROM customer",
        "overwrite_twice": "SELECT * FROM nation WHERE n_regionkey = 1",
        "overwrite_empty_keeps": "SELECT * FROM nation",
        "sinks": "SELECT * FROM nation WHERE n_regionkey < 3 OR n_regionkey = 4",
        "create_table": "SELECT * FROM region",
        "partition_identity": f"SELECT {integer('o_orderkey')}, o_orderstatus AS _p_o_orderstatus FROM orders",
        "partition_truncate": f"SELECT {integer('o_orderkey')}, substr(o_orderpriority, 1, 1) "
        "AS _p_o_orderpriority_truncate, CAST(o_custkey - o_custkey % 500 AS INTEGER) "
        "AS _p_o_custkey_truncate FROM orders",
        "partition_bucket": "SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys, "
        "count(DISTINCT o_custkey) AS n_key_buckets, CAST(4 AS BIGINT) AS n_buckets FROM orders",
        "partition_bucket_spec": f"SELECT {integer('o_orderkey')}, {murmur_sql('o_custkey', 16)} AS by_key, "
        f"{murmur_sql('epoch_us(o_orderdate)', 7)} AS by_date FROM orders",
        "streaming_states": "SELECT max(event_id) AS event_id, count(*) AS n, (SELECT count(*) FROM events) AS loaded, "
        "unnest(['one file', 'all files']) AS batch FROM events WHERE event_id % 3 = 2",
        "append_null_column": f"SELECT {integer('c_custkey')}, c_name, CAST(NULL AS VARCHAR) AS nothing FROM customer",
        "duplicate_keys": f"SELECT {integer('p_partkey')}, p_size AS s FROM part",
        "partition_empty_text": f"SELECT {integer('c_custkey')}, c_name AS _sync_id FROM customer WHERE c_acctbal < 0",
        "partition_void": "SELECT n_nationkey FROM nation",
        "partition_year": event_partition("CAST(year(ts) AS INTEGER)", "year"),
        "partition_month": event_partition("CAST(date_trunc('month', ts) AS DATE)", "month"),
        "partition_day": event_partition("CAST(ts AS DATE)", "day"),
        "partition_hour": event_partition("CAST(date_trunc('hour', ts) AS TIMESTAMP)", "hour"),
        "branch_write": "SELECT 'main' AS branch, r_regionkey, r_name FROM region "
        "UNION ALL SELECT 'main', r_regionkey, r_name FROM region WHERE r_regionkey < 2 "
        "UNION ALL SELECT 'side', r_regionkey, r_name FROM region",
        "commit_history": "SELECT CAST(1 AS BIGINT) AS seq, 'create' AS mode, CAST(0 AS BIGINT) AS added_rows "
        "UNION ALL SELECT CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 4 END, 'append', "
        "count(*) FROM orders GROUP BY o_orderstatus",
        "last_global_state": f"SELECT {LAST_EVENT} AS event_id FROM events",
        "last_stream_state": f"SELECT event_type AS stream, {LAST_EVENT} AS event_id FROM events "
        "GROUP BY event_type",
        "resolved_state": STATES,
        "generate_state": f"SELECT 'GLOBAL' AS type, 'default' AS namespace, stream, total, cursor_at FROM ({STATES})",
        "keyword_report": keyword_counts(),
        "undeclared_fields": UNDECLARED,
        "rejected_lines": reason_counts(),
        "checked_load": "SELECT p_partkey, p_type, CAST(NULL AS VARCHAR) AS absent FROM part",
        "streaming_last_states": "SELECT event_type AS stream, arg_max(event_id, (event_id % 3, ts, event_id)) AS event_id "
        "FROM events WHERE event_type <> 'view' OR event_id % 3 < 2 GROUP BY event_type",
        "streaming_append": f"SELECT {integer('event_id')}, ts, {integer('user_id')}, event_type, "
        f"{real('value')}, props FROM events",
    }
