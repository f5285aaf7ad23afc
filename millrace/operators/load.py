"""The load path of a sync: strict check and typed decode of one stream in a single parse.

Numbers and booleans are parsed straight to their type; the JSON parser itself refuses any other kind.
Dates and times are parsed as text, whose format no other kind of value has. Other texts and nested
values are parsed to VARIANT and checked. A record the typed parse cannot vouch for (a wrong value, or a rare spelling such as 1.0 for
a 64-bit integer) is parsed again as a whole VARIANT and judged by the same checks as ``validate``, so both
paths accept the same records and raise the same errors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import variants as V
from millrace.functions.checks import WIDE, all_of, is_plain, object_ok, record_errors, type_ok, value_ok
from millrace.functions.decoding import decode_object, decode_value
from millrace.functions.jsonschema import RAW_KEY, raw_key, type_list
from millrace.functions.keywords import NONE, compile_keywords
from millrace.operators.envelope import CORRUPT, MALFORMED, PLACE, once, parse_json, require
from millrace.operators.records import error_message


def carrier_type(field: T.StructField, node: dict | None) -> T.DataType:
    """What a column's value is parsed as."""
    if is_plain(field, node):
        if isinstance(field.dataType, (T.BooleanType, T.LongType)):
            return field.dataType
        # A double holds every 32-bit integer, and sources that print integers as 1.0 need no second parse.
        if isinstance(field.dataType, (T.IntegerType, T.FloatType, T.DoubleType)):
            return T.DoubleType()
        if V.is_format(field.dataType):
            return T.StringType()
    return T.VariantType()


def payload_type(schema: dict, struct: T.StructType) -> T.StructType:
    """What the payload of a stream is parsed as: the table's keys and whatever else is checked."""
    nodes = schema.get("properties", {})
    columns = {raw_key(field): carrier_type(field, nodes.get(raw_key(field))) for field in struct}
    for key, node in nodes.items():
        if key not in columns and type_list(node):
            columns[key] = T.VariantType()
    return T.StructType([T.StructField(key, data_type) for key, data_type in columns.items()])


def all_good(payload: T.StructType, schema: dict, struct: T.StructType) -> str:
    """Whether a parsed payload has no error, up to the format of text carriers."""
    nodes = schema.get("properties", {})
    fields = {raw_key(field): field for field in struct}
    conditions = []
    numbers: dict[tuple[bool, bool], list[str]] = {}  # values by whether they are integers, and may be missing
    for carrier in payload:
        value = _parsed(carrier.name)
        field, node = fields.get(carrier.name), nodes.get(carrier.name)
        if isinstance(carrier.dataType, T.DoubleType):
            numbers.setdefault((isinstance(field.dataType, T.IntegerType), field.nullable), []).append(value)
        elif isinstance(carrier.dataType, T.VariantType):
            if field is not None:
                conditions.append(value_ok(value, field.dataType, field.nullable))
            if node is not None and (field is None or not is_plain(field, node)):
                conditions.append(type_ok(value, node))
        elif not field.nullable:
            conditions.append(f"({value} IS NOT NULL)")
    for like, values in numbers.items():
        if len(values) > WIDE:
            conditions.append(f"forall(array({', '.join(values)}), x -> {_number_ok('x', *like)})")
        else:
            conditions += [_number_ok(value, *like) for value in values]
    return all_of(conditions)


def _number_ok(value: str, integer: bool, nullable: bool) -> str:
    good = V.is_finite(value)
    if integer:
        good = f"coalesce({value} BETWEEN -2147483648 AND 2147483647 AND rint({value}) = {value}, false)"
    return f"({value} IS NULL OR {good})" if nullable else good


def parse_payload(schema: dict, struct: T.StructType) -> Column:
    """The one parse of a stream's lines."""
    return once(parse_json(payload_type(schema, struct)))


def load_records(df: DataFrame, schema: dict, struct: T.StructType, keywords: tuple[str, ...] | None = None) -> DataFrame:
    """Checked, typed columns of one stream's records.

    ``df`` has the lines of well-formed RECORD messages in ``value``, their ``_pos``, and the result
    of ``parse_payload`` in ``_parsed``. ``keywords``: check the schema's other keywords too, but for the ones given; then
    every record is parsed as a whole once more.
    """
    names = _names(struct)
    whole = parse_json(T.VariantType())["m"]["record"]["data"]
    exact = T.StructType(
        [T.StructField(n, f.dataType, True, {RAW_KEY: raw_key(f)}) for n, f in zip(names, struct)]
    )
    fits = V.bind("_whole", "w", all_of([type_ok("w", schema), object_ok("w", struct)]))
    passes, violations = compile_keywords(schema, keywords, "w") if keywords is not None else ("true", NONE)
    all_errors = record_errors("w", schema, struct)
    if passes != "true":
        all_errors = f"concat({all_errors}, {violations})"
    errors = V.bind("_whole", "w", all_errors)
    row = V.bind("_whole", "w", decode_object("w", exact))
    return (
        _typed(df, schema, struct)
        .withColumn("_whole", once(F.when(F.expr("NOT _sure"), whole) if passes == "true" else whole))
        .withColumn("_fits", once(f"(_sure OR (_whole IS NOT NULL AND {fits}))" + ("" if passes == "true" else f" AND {V.bind('_whole', 'w', passes)}")))
        .withColumn("_errors", once(f"if(_fits, NULL, {errors})"))
        .where(
            require(
                "_fits",
                f"if(_whole IS NULL, {MALFORMED}, concat({error_message('_errors', '_whole')}, ', ', {PLACE}))",
            )
        )
        .select("_sure", *names, once(f"if(_sure, NULL, {row})").alias("_exact"))
        .select(
            *(
                F.expr(f"if(_sure, {n}, _exact.{n})").alias(field.name)
                for n, field in zip(names, struct)
            )
        )
    )


def _names(struct: T.StructType) -> list[str]:
    """Working names of the columns, which cannot clash with helper columns."""
    return [f"_c{i}" for i in range(len(struct))]


def _parsed(key: str) -> str:
    return "_parsed.m.record.data." + V.name(key)


def _typed(df: DataFrame, schema: dict, struct: T.StructType) -> DataFrame:
    """Typed columns and ``_sure``: whether they are surely free of errors."""
    payload = payload_type(schema, struct)
    carriers = {field.name: field.dataType for field in payload}
    columns, absent, parses = [], [], []
    for name, field in zip(_names(struct), struct):
        value, carrier = _parsed(raw_key(field)), carriers[raw_key(field)]
        if isinstance(carrier, T.StringType):
            columns.append(f"{V.parse_format(value, field.dataType)} AS {name}")
            if field.nullable:
                absent.append(f"{value} IS NULL AS {name}_absent")
                parses.append(f"({name} IS NOT NULL OR {name}_absent)")
            else:
                parses.append(f"({name} IS NOT NULL)")
        elif isinstance(carrier, T.VariantType):
            columns.append(f"{decode_value(value, field.dataType)} AS {name}")
        else:
            cast = "try_cast" if isinstance(field.dataType, T.IntegerType) else "cast"
            columns.append(f"{cast}({value} AS {field.dataType.simpleString()}) AS {name}")
    clean = f"_parsed.{CORRUPT} IS NULL AND _parsed.m.record.data IS NOT NULL"
    return df.select(
        "value",
        "_pos",
        once(f"{clean} AND {all_good(payload, schema, struct)}").alias("_good"),
        *(F.expr(c) for c in columns + absent),
    ).select("value", "_pos", once(all_of(["_good", *parses])).alias("_sure"), *_names(struct))
