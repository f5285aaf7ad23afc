"""Envelope parse, message kinds and routing.

Every line is parsed once: the parse is marked with ``once``, or the optimizer would push filters on
parsed fields below it and repeat it in every one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import variants as V
from millrace.session import allow_duplicate_keys
from millrace.sources.messages import number_lines

# Message types of the public connector protocol.
MESSAGE_TYPES = [
    "RECORD",
    "STATE",
    "LOG",
    "TRACE",
    "CATALOG",
    "SPEC",
    "CONNECTION_STATUS",
    "CONTROL",
    "DESTINATION_CATALOG",
]

CORRUPT = "_corrupt"

# Strict JSON: no single quotes, no NaN or Infinity.
PARSE_OPTIONS = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "columnNameOfCorruptRecord": CORRUPT,
}

# Messages that have to name a stream of the catalog, and the ones a sync uses at all.
NAMES_STREAM = "(kind = 'RECORD' OR coalesce(state_kind = 'STREAM', false))"
IS_USED = "(kind = 'RECORD' OR coalesce(state_kind IN ('GLOBAL', 'STREAM'), false))"

# Place of a line, for error messages.
PLACE = "concat('line ', _pos.line, ' of split ', _pos.block, ' of ', _pos.file)"
MALFORMED = f"concat('Malformed message, ', {PLACE}, ': ', value)"
NOT_FOUND = "concat('The catalog has no stream ', coalesce(stream, ''))"


# A line that closes its object early and goes on would be one more key of the wrapper.
ONE_VALUE = "size(json_object_keys(concat('{\"m\":', value, '}'))) = 1"


@dataclass(frozen=True)
class Descriptor:
    """Key of a stream; no namespace is a key of its own."""

    name: str
    namespace: str | None = None


def once(column: Column | str) -> Column:
    """Evaluate a costly column where it stands.

    A filter is not pushed through a projection that holds a non-deterministic expression, and such a
    projection is not merged into others. The condition is always true.
    """
    column = F.expr(column) if isinstance(column, str) else column
    return F.when(F.expr("monotonically_increasing_id() >= 0"), column)


def require(good: str, message: str) -> Column:
    """Filter condition that ends the job with ``message`` on the first row that is not good.

    As a filter it also fires when no column of the row is asked for.
    """
    return F.expr(f"CASE WHEN {good} THEN true ELSE cast(raise_error({message}) AS boolean) END")


def message_lines(df: DataFrame) -> DataFrame:
    """Lines with the shape of a message; all else is dropped silently. No trimming."""
    return number_lines(df).where("startswith(value, '{') AND endswith(value, '}')")


def parse_json(data_type: T.DataType | None) -> Column:
    """Parse ``value`` to ``struct<m: envelope, _corrupt>``.

    ``data_type`` is what the payload is read as; None skips it. The line is wrapped in one more
    object: Spark's parser stops after the first JSON value, and inside the wrapper whatever
    follows that value is a syntax error or one more key, which ``well_formed`` refuses.
    """
    string = T.StringType()
    descriptor = T.StructType().add("name", string).add("namespace", string)
    record = T.StructType().add("stream", string).add("namespace", string)
    if data_type is not None:
        record = record.add("data", data_type)
    part = T.StructType().add("stream_descriptor", descriptor)
    state = (
        T.StructType()
        .add("type", string)
        .add("stream", T.StructType().add("stream_descriptor", descriptor))
        .add("global", T.StructType().add("stream_states", T.ArrayType(part)))
    )
    envelope = T.StructType().add("type", string).add("record", record).add("state", state)
    schema = T.StructType().add("m", envelope).add(CORRUPT, string)
    return F.from_json(F.expr("concat('{\"m\":', value, '}')"), schema, PARSE_OPTIONS)


def envelope_columns(parsed: str) -> dict[str, str]:
    """Kind, descriptor and state kind of a parsed line."""
    message = f"{parsed}.m"
    is_state = f"{message}.type = 'STATE'"
    descriptor = f"{message}.state.stream.stream_descriptor"
    return {
        "kind": f"{message}.type",
        "stream": f"if({is_state}, {descriptor}.name, {message}.record.stream)",
        "namespace": f"if({is_state}, {descriptor}.namespace, {message}.record.namespace)",
        "state_kind": f"if({is_state}, {message}.state.type, NULL)",
    }


def well_formed(parsed: str, has_data: bool = True) -> str:
    """Whether a line that looks like a message is a valid one."""
    message = f"{parsed}.m"
    record = f"{message}.record.stream IS NOT NULL"
    if has_data:
        record += f" AND {message}.record.data IS NOT NULL"
    state = (
        f"{message}.state IS NOT NULL AND CASE {message}.state.type"
        f" WHEN 'STREAM' THEN {message}.state.stream.stream_descriptor.name IS NOT NULL"
        f" WHEN 'GLOBAL' THEN {message}.state.global IS NOT NULL AND coalesce(forall("
        f"{message}.state.global.stream_states, s -> s.stream_descriptor.name IS NOT NULL), true) ELSE true END"
    )
    types = ", ".join(V.literal(t) for t in MESSAGE_TYPES)
    return (
        f"coalesce({parsed}.{CORRUPT} IS NULL AND is_valid_utf8(value) AND {ONE_VALUE} AND CASE {message}.type"
        f" WHEN 'RECORD' THEN {record} WHEN 'STATE' THEN {state}"
        f" ELSE {message}.type IN ({types}) END, false)"
    )


def reason(parsed: str, has_data: bool = True) -> str:
    """Why a line that looks like a message is none; NULL for a valid one."""
    message = f"{parsed}.m"
    types = ", ".join(V.literal(t) for t in MESSAGE_TYPES)
    descriptor = f"{message}.state.stream.stream_descriptor.name"
    data = f" WHEN {message}.type = 'RECORD' AND {message}.record.data IS NULL THEN 'no data'" if has_data else ""
    return (
        f"CASE WHEN {well_formed(parsed, has_data)} THEN NULL"
        f" WHEN NOT is_valid_utf8(value) THEN 'not UTF-8'"
        f" WHEN NOT coalesce({ONE_VALUE}, json_object_keys(value) IS NULL) THEN 'two values'"
        f" WHEN try_parse_json(concat('{{\"m\":', value, '}}')) IS NULL THEN 'not JSON'"
        f" WHEN {parsed}.{CORRUPT} IS NOT NULL OR {message} IS NULL THEN 'wrong shape'"
        f" WHEN {message}.type IS NULL OR {message}.type NOT IN ({types}) THEN 'unknown kind'"
        f" WHEN {message}.type = 'RECORD' AND {message}.record.stream IS NULL THEN 'no stream'{data}"
        f" WHEN {message}.state.type = 'STREAM' AND {descriptor} IS NULL THEN 'state without a stream'"
        f" ELSE 'malformed state' END"
    )


def judge_lines(df: DataFrame) -> DataFrame:
    """Lines that look like messages, with ``reason``: why one is none, NULL for valid ones. One parse of each line."""
    allow_duplicate_keys(df.sparkSession)
    parsed = message_lines(df).select("value", "_pos", once(parse_json(T.VariantType())).alias("_parsed"))
    columns = [f"{text} AS {name}" for name, text in envelope_columns("_parsed").items()]
    return parsed.select("*", once(reason("_parsed")).alias("reason")).selectExpr(
        "value", "_pos", *columns, "_parsed.m.record.data AS data", "reason"
    )


def rejected_lines(df: DataFrame) -> DataFrame:
    """Malformed lines as rows: where they are (file, block, line), what they are, and why."""
    return judge_lines(df).where("reason IS NOT NULL").select("_pos.file", "_pos.block", "_pos.line", "value", "reason")


def parse_envelope(df: DataFrame) -> DataFrame:
    """Message lines split into kind, descriptor and payload; a malformed line ends the job."""
    allow_duplicate_keys(df.sparkSession)
    parsed = message_lines(df).select(
        "value", "_pos", once(parse_json(T.VariantType())).alias("_parsed")
    )
    columns = [f"{text} AS {name}" for name, text in envelope_columns("_parsed").items()]
    return parsed.where(require(well_formed("_parsed"), MALFORMED)).selectExpr(
        "value", "_pos", *columns, "_parsed.m.record.data AS data"
    )


def records(df: DataFrame) -> DataFrame:
    """The RECORD messages of a parsed envelope."""
    return df.where("kind = 'RECORD'")


def states(df: DataFrame) -> DataFrame:
    """The STATE messages of a parsed envelope."""
    return df.where("kind = 'STATE'")


def matches(descriptor: Descriptor) -> str:
    space = "NULL" if descriptor.namespace is None else V.literal(descriptor.namespace)
    return f"(stream <=> {V.literal(descriptor.name)} AND namespace <=> {space})"


def route(df: DataFrame, descriptor: Descriptor) -> DataFrame:
    """The messages of one stream."""
    return df.where(matches(descriptor))


def descriptor_table(spark: SparkSession, descriptors: list[Descriptor]) -> DataFrame:
    """The streams of a catalog as rows, with their place in it.

    Always broadcast: the driver holds the catalog with a schema for each, and a row here is its name only.
    """
    rows = [(i, d.name, d.namespace) for i, d in enumerate(descriptors)]
    table = spark.createDataFrame(rows, "_route int, _name string, _space string")
    return F.broadcast(table)


SAME_STREAM = "stream = _name AND namespace <=> _space"


def unknown_streams(df: DataFrame, descriptors: list[Descriptor]) -> DataFrame:
    """Streams that records or STREAM states name but the catalog does not, with message counts.

    Messages are counted per stream first, so that only one row per stream meets the catalog.
    """
    counts = df.where(NAMES_STREAM).groupBy("stream", "namespace").agg(F.count(F.lit(1)).alias("n"))
    known = descriptor_table(df.sparkSession, descriptors)
    return counts.join(known, F.expr(SAME_STREAM), "left_anti")
