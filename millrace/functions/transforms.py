"""Partition transforms as derived columns.

A table partitioned by a transform of a column gets one more column ``_p_<column>``, with the
transform's name behind it unless it is the identity. The data columns stay as they are.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.murmur import bucket

# Spellings of the transforms.
TRANSFORM_PATTERN = re.compile(r"^(identity|year|month|day|hour|void|(bucket|truncate)\[(\d+)\])$")


def parse_transform(text: str) -> tuple[str, int | None]:
    """Name and width of a transform, bare or in double quotes."""
    found = TRANSFORM_PATTERN.match(text.strip().strip('"').strip().lower())
    if not found:
        raise ValueError(f"Unknown partition transform {text}.")
    name = found.group(2) or found.group(1)
    width = int(found.group(3)) if found.group(3) else None
    if width == 0:
        raise ValueError(f"The width of {text} has to be above zero.")
    return name, width


def free_label(label: str, struct: T.StructType) -> str:
    """The label, with underscores as long as a column of the table has it; names don't tell cases apart."""
    taken = {field.name.lower() for field in struct}
    while label.lower() in taken:
        label += "_"
    return label


def partition_label(struct: T.StructType, column: str, transform: str) -> str:
    return free_label(f"_p_{column}" if transform == "identity" else f"_p_{column}_{transform}", struct)


def to_folder(value: Column, data_type: T.DataType) -> Column:
    """What a partition value is stored as: texts get a mark, as an empty folder name would read as null."""
    return F.concat(F.lit("="), value) if isinstance(data_type, T.StringType) else value


def from_folder(value: Column, data_type: T.DataType) -> Column:
    return F.substring(value, 2, 2**31 - 1) if isinstance(data_type, T.StringType) else value


def partition_columns(struct: T.StructType, partition_by: dict[str, str]) -> dict[str, Column]:
    """Partition columns by name, in the order of ``partition_by``."""
    columns: dict[str, Column] = {}
    fields = {field.name: field for field in struct}
    for column, text in partition_by.items():
        if column not in fields:
            raise ValueError(f"There is no column {column} to partition by.")
        name, width = parse_transform(text)
        if name == "void":
            continue
        columns[partition_label(struct, column, name)] = _derive(F.col(f"`{column}`"), fields[column].dataType, name, width)
    return columns


def partition_types(struct: T.StructType, partition_by: dict[str, str]) -> T.StructType:
    """Types of the partition columns, for reading them back."""
    result = T.StructType()
    for column, text in partition_by.items():
        name, _ = parse_transform(text)
        source = struct[column].dataType
        if name == "identity":
            result = result.add(partition_label(struct, column, name), source)
        elif name != "void":
            fixed = {
                "year": T.IntegerType(),
                "month": T.DateType(),
                "day": T.DateType(),
                "hour": T.TimestampNTZType(),
                "bucket": T.IntegerType(),
            }
            result = result.add(partition_label(struct, column, name), fixed.get(name, source))
    return result


def _derive(value: Column, data_type: T.DataType, name: str, width: int | None) -> Column:
    if isinstance(data_type, (T.StructType, T.ArrayType, T.NullType)):
        raise ValueError(f"A {data_type.simpleString()} column cannot be partitioned by {name}.")
    if name == "identity":
        return value
    if name == "bucket":
        return bucket(value, data_type, width)
    if name == "truncate":
        if isinstance(data_type, T.StringType):
            return F.substring(value, 1, width)
        if isinstance(data_type, (T.IntegerType, T.LongType)):
            return (value - F.pmod(value, F.lit(width))).cast(data_type)
        raise ValueError(f"A {data_type.simpleString()} column cannot be truncated.")
    is_time = isinstance(data_type, T.TimestampNTZType)
    if not (is_time or (isinstance(data_type, T.DateType) and name != "hour")):
        raise ValueError(f"A {data_type.simpleString()} column has no {name}.")
    if name == "year":
        return F.year(value)
    if name == "month":
        return F.trunc(value.cast("date"), "month")
    if name == "day":
        return value.cast("date")
    # Zone-less subtraction: date_trunc would go by way of the session time zone.
    into_hour = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(value), F.extract(F.lit("SECOND"), value))
    return (value - into_hour).cast("timestamp_ntz")
