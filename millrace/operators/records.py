"""Validation and typed decode of records whose payload is a VARIANT in ``data``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import variants as V
from millrace.functions.checks import (
    all_of,
    decode_errors,
    is_plain,
    record_errors,
    type_condition,
    type_ok,
    value_ok,
)
from millrace.functions.decoding import decode_value
from millrace.functions.jsonschema import raw_key, to_struct, type_list
from millrace.functions.keywords import compile_keywords
from millrace.operators.envelope import once, require
from millrace.session import enable_time_type


def error_message(errors: str, data: str) -> str:
    """Text of the first error of a record."""
    first = f"get({errors}, 0)"
    return (
        f"concat(coalesce({first}.message, 'invalid record'), ' at ', coalesce({first}.path, '$'), "
        f"' in data ', coalesce(to_json({data}), 'null'))"
    )


def validate(
    df: DataFrame, schema: dict, wide_numbers: bool = False, struct: T.StructType | None = None, keywords: bool = False
) -> DataFrame:
    """Check every record against the stream's JSON Schema; the first error ends the job.

    ``struct`` is the table schema the records go to; without it the one of the JSON Schema. ``keywords`` checks
    the schema's other keywords too.
    """
    struct = struct or to_struct(schema, wide_numbers)
    df = check_keywords(df, schema) if keywords else df
    return (
        _judge(df, schema, struct)
        .withColumn("_errors", once(f"if(_good, NULL, {V.bind('data', 'd', record_errors('d', schema, struct))})"))
        .where(require("_good", error_message("_errors", "data")))
        .drop("_good", "_errors")
    )


def validation_report(
    df: DataFrame, schema: dict, wide_numbers: bool = False, struct: T.StructType | None = None
) -> DataFrame:
    """The same check with the errors as rows: one row per error, next to the record's columns."""
    struct = struct or to_struct(schema, wide_numbers)
    return (
        _judge(df, schema, struct)
        .where("NOT _good")
        .drop("_good")
        .withColumn("_error", F.explode(F.expr(record_errors("data", schema, struct))))
        .select("*", "_error.path", "_error.rule", "_error.message")
        .drop("_error")
    )


def keyword_report(df: DataFrame, schema: dict, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Violations of the schema's other keywords (bounds, patterns, choices and the like), a row each, next to the record's columns.

    Keywords that are not known, and those not in ``ignored``, are an error before any job.
    """
    errors = compile_keywords(schema, ignored, "d")[1]
    # In a lambda: hundreds of checks in the generated code would keep it from being compiled. A record without errors has no row.
    found = once(f"if(data IS NULL, NULL, {V.bind('data', 'd', errors)})")
    return (
        df.withColumn("_errors", found)
        .withColumn("_error", F.explode("_errors"))
        .select(*df.columns, "_error.path", "_error.rule", "_error.message")
    )


def check_keywords(df: DataFrame, schema: dict, ignored: tuple[str, ...] = ()) -> DataFrame:
    """The records; the first that violates a keyword ends the job."""
    good, errors = compile_keywords(schema, ignored, "d")
    if good == "true":
        return df
    return (
        df.withColumn("_passes", once(V.bind("data", "d", good)))
        .withColumn("_errors", once(f"if(_passes, NULL, {V.bind('data', 'd', errors)})"))
        .where(require("_passes", error_message("_errors", "data")))
        .drop("_passes", "_errors")
    )


def undeclared_fields(df: DataFrame, schema: dict) -> DataFrame:
    """What the columns of the schema leave out: (path, n, kind) of each field that records have and the schema does not.

    ``kind`` is the type that all values of the path have in common, with everything below it. Fields of declared
    objects and of objects in declared arrays are told one by one. Counts are added up before the one shuffle, whose
    size is that of the list of paths.
    """
    nodes = ", ".join(_object_nodes("data", "$", schema, "'$'", 0))
    # Once: the optimizer puts a filter on the list's size before an explode, and would make the list a second time for it.
    listed = df.select(once(f"concat({nodes})").alias("_nodes"))
    objects = listed.select(F.explode("_nodes").alias("o")).select("o.path", "o.known", "o.value")
    fields = objects.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("value").outer()))
    found = fields.where(F.col("key").isNotNull() & ~F.array_contains("known", F.col("key")))
    # variant_explode names its columns pos, key and value; the object's own value is the first of that name.
    return (
        found.toDF("path", "known", "object", "pos", "key", "field")
        .groupBy(F.concat("path", F.lit("."), "key").alias("path"))
        .agg(F.count(F.lit(1)).alias("n"), F.expr("schema_of_variant_agg(field)").alias("kind"))
    )


def _object_nodes(root: str, steps: str, schema: dict, path: str, depth: int) -> list[str]:
    """SQL arrays of (path, known keys, value) of the declared objects below ``root`` at the variant path ``steps``.

    Everything is read by its whole path: a value that is taken out of another as a variant is copied first.
    """
    properties = schema.get("properties", {})
    known = ", ".join(V.literal(key) for key in properties)
    keys = f"array({known})" if known else "cast(array() AS array<string>)"
    value = root if steps == "$" else V.read(root, steps, "variant")
    own = f"array(named_struct('path', {path}, 'known', {keys}, 'value', {value}))"
    found = [f"if({V.read(root, steps, 'struct<>')} IS NOT NULL, {own}, array())"]
    for key, node in properties.items():
        found += _nodes_below(root, steps + V.child_path(key)[1:], node, f"concat({path}, {V.literal('.' + key)})", depth)
    return found


def _nodes_below(root: str, steps: str, node: dict, path: str, depth: int) -> list[str]:
    if "properties" in node:
        return _object_nodes(root, steps, node, path, depth)
    if isinstance(node.get("items"), dict):
        x = f"x{depth}"
        inner = _nodes_below(x, "$", node["items"], f"concat({path}, '[]')", depth + 1)
        if inner:
            return [f"coalesce(flatten(transform({V.read(root, steps, 'array<variant>')}, {x} -> concat({', '.join(inner)}))), array())"]
    return []


def decode(df: DataFrame, struct: T.StructType) -> DataFrame:
    """The declared columns of each record, typed; a record that does not fit ends the job."""
    checked = _with_values(df, struct).withColumn("_good", once(_values_ok(struct)))
    columns = (
        F.expr(decode_value(V.name("_values", f"v{i}"), field.dataType)).alias(field.name)
        for i, field in enumerate(struct)
    )
    return (
        checked.withColumn("_errors", once(f"if(_good, NULL, {V.bind('data', 'd', decode_errors('d', struct))})"))
        .where(require("_good", error_message("_errors", "data")))
        .select(*columns)
    )


def _judge(df: DataFrame, schema: dict, struct: T.StructType) -> DataFrame:
    """Add ``_good``: whether a record has no error."""
    nodes = schema.get("properties", {})
    keys = {raw_key(field) for field in struct}
    # What the table's columns do not vouch for: that it is an object, and laxer or further properties.
    rest = [type_condition("d", schema)]
    for field in struct:
        node = nodes.get(raw_key(field))
        if node is not None and not is_plain(field, node):
            rest.append(type_ok(V.child("d", raw_key(field)), node))
    rest += [type_ok(V.child("d", k), n) for k, n in nodes.items() if k not in keys and type_list(n)]
    good = all_of([V.bind("data", "d", all_of(rest)), _values_ok(struct)])
    return _with_values(df, struct).withColumn("_good", once(good)).drop("_values")


def _with_values(df: DataFrame, struct: T.StructType) -> DataFrame:
    """Take the declared values out of the payload once, for the checks and the decode."""
    enable_time_type(df.sparkSession, struct)
    values = (f"'v{i}', {V.child('data', raw_key(f))}" for i, f in enumerate(struct))
    return df.withColumn("_values", once(f"named_struct({', '.join(values)})"))


def _values_ok(struct: T.StructType) -> str:
    conditions = [
        value_ok(f"v.v{i}", field.dataType, field.nullable) for i, field in enumerate(struct)
    ]
    return V.bind("_values", "v", all_of(conditions))
