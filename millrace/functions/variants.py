"""Reading typed values out of VARIANT columns.

``variant_get`` is lenient across kinds (the text "1" reads as the integer 1), so every read comes
with a check of the kind the JSON value really had.

The functions take and give SQL expression text. A stream can have hundreds of columns with several
checks each; as text they reach Spark as one expression instead of thousands of calls.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Accepted spellings of dates, date-times and times.
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
DATE_TIME_PATTERN = (
    "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?"
    "(Z|[+-][0-9]{2}:?[0-9]{2})?$"
)
TIME_PATTERN = "^[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?$"

LARGEST_DOUBLE = "1.7976931348623157E308D"


def name(*parts: str) -> str:
    """A column reference; every part is quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(value: str, variable: str, body: str) -> str:
    """``body`` with a variable standing for ``value``.

    For large expressions few rows need: a lambda body is not put into the generated code, where it
    would make the method too large for the JVM to compile and slow down every row.
    """
    return f"get(transform(array({value}), {variable} -> {body}), 0)"


_TEXT = r"'(?:[^'\\]|\\.)*'"
_READ = r"(?:schema_of_variant\({0}\)|map_entries\(try_variant_get\({0}, '\$', 'map<string,variant>'\)\)|try_variant_get\({0}, {1}, '(?!double)[^']*'\))"


def share(variable: str, body: str) -> str:
    """``body`` with what it reads more than once out of ``variable``, or out of what was so read, bound to variables.

    A lambda is interpreted, and reads a value each time that it is named. Numbers as doubles stay as they are: few values get that far.
    """
    atoms, wraps = re.escape(variable), []
    while True:
        pattern = re.compile(f"({_READ.format(f'(?:{atoms})', _TEXT)})|{_TEXT}")
        times: dict[str, int] = {}
        for found in pattern.finditer(body):
            if found[1]:
                times[found[1]] = times.get(found[1], 0) + 1
        scope = f"{variable}_{len(wraps)}"
        names = {text: f"{scope}.x{i}" for i, text in enumerate(t for t, n in times.items() if n > 1)}
        if not names:
            break
        body = pattern.sub(lambda found: names.get(found[1], found[0]), body)
        wraps.append((f"named_struct({', '.join(f"'x{i}', {text}" for i, text in enumerate(names))})", scope))
        atoms = rf"{re.escape(scope)}\.x\d+"
    for value, scope in reversed(wraps):
        body = bind(value, scope, body)
    return body


def child_path(key: str) -> str:
    """Variant path of one key, whatever characters it has."""
    if "'" not in key:
        return f"$['{key}']"
    if '"' not in key:
        return f'$["{key}"]'
    raise ValueError(f"The property name {key} mixes both kinds of quotes.")


def read(value: str, path: str, data_type: str) -> str:
    """What lies at a variant path, as a type; SQL NULL when nothing does or it is of another kind."""
    return f"try_variant_get({value}, {literal(path)}, '{data_type}')"


def child(value: str, key: str) -> str:
    """The value under a key as a variant; SQL NULL when the key is missing or value is no object."""
    return read(value, child_path(key), "variant")


def elements(value: str) -> str:
    """The elements of a JSON array; SQL NULL for every other kind."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def kind(value: str) -> str:
    """SQL type name of the JSON value: VOID for a JSON null, SQL NULL when missing."""
    return f"schema_of_variant({value})"


def is_null(value: str) -> str:
    """Missing or JSON null."""
    return f"({value} IS NULL OR is_variant_null({value}))"


def is_finite(number: str) -> str:
    return f"({number} BETWEEN -{LARGEST_DOUBLE} AND {LARGEST_DOUBLE})"


def is_number(value: str) -> str:
    found, number = kind(value), f"try_variant_get({value}, '$', 'double')"
    # The first test settles BIGINT and every DECIMAL(p,s) with one look at the value.
    return (
        f"(left({found}, 3) IN ('BIG', 'DEC') OR ({found} = 'DOUBLE' AND {is_finite(number)}))"
    )


def is_integer(value: str) -> str:
    """An integral number; 1.0 counts as one."""
    found, number = kind(value), f"try_variant_get({value}, '$', 'double')"
    return (
        f"({found} = 'BIGINT' OR (startswith({found}, 'DECIMAL(') AND endswith({found}, ',0)'))"
        f" OR ({found} = 'DOUBLE' AND {is_finite(number)} AND {number} = floor({number})))"
    )


def is_kind(value: str, json_type: str) -> str:
    """Whether a present value has one of the JSON Schema types."""
    if json_type == "integer":
        return is_integer(value)
    if json_type == "number":
        return is_number(value)
    # One look at the value itself: neither test reads what lies below it, as a printed schema would.
    if json_type == "object":
        return f"(try_variant_get({value}, '$', 'struct<>') IS NOT NULL)"
    if json_type == "array":
        return f"(try_variant_get({value}, '$', 'array<boolean>') IS NOT NULL)"
    if json_type == "null":
        return f"coalesce(is_variant_null({value}), false)"
    name_of = {"boolean": "BOOLEAN", "string": "STRING"}[json_type]
    return f"({kind(value)} = '{name_of}')"


def text(value: str) -> str:
    return f"try_variant_get({value}, '$', 'string')"


def parse_date(string: str) -> str:
    """Date of an ISO text; NULL when it is none."""
    return f"if({string} RLIKE '{DATE_PATTERN}', try_cast({string} AS date), NULL)"


def parse_date_time(string: str) -> str:
    """Zone-less UTC timestamp of an ISO text; NULL when it is none.

    The value does not depend on the session time zone: a text without an offset counts as UTC, and
    the microseconds since the epoch are added to a zone-less epoch.
    """
    tail = f"substring({string}, 20)"
    has_offset = f"(contains({tail}, 'Z') OR contains({tail}, '+') OR contains({tail}, '-'))"
    zoned = f"if({has_offset}, {string}, concat({string}, 'Z'))"
    instant = f"if({string} RLIKE '{DATE_TIME_PATTERN}', try_cast({zoned} AS timestamp), NULL)"
    return f"timestampadd(MICROSECOND, unix_micros({instant}), TIMESTAMP_NTZ'1970-01-01 00:00:00')"


def parse_time(string: str) -> str:
    """Time of day cut to milliseconds; NULL when the text is none."""
    return (
        f"if({string} RLIKE '{TIME_PATTERN}', try_cast(substring({string}, 1, 12) AS time(3)), NULL)"
    )


def parse_format(string: str, data_type: T.DataType) -> str:
    if isinstance(data_type, T.DateType):
        return parse_date(string)
    if isinstance(data_type, T.TimestampNTZType):
        return parse_date_time(string)
    return parse_time(string)


def is_format(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampNTZType, T.TimeType))
