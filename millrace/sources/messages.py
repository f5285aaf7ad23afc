"""Message lines as DataFrames.

A message DataFrame has the raw line in ``value`` and its place in the input in ``_pos``. Input order
is file path, then split, then line; in streams, files come by the time they were last written before their
path. ``monotonically_increasing_id`` alone is not enough, since Spark packs splits into tasks by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_messages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Batch scan of JSON-lines files."""
    return number_lines(scan_splits(spark, path))


def scan_splits(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same without numbers: filters on ``_file`` and ``_block`` keep other files from being read."""
    return _with_splits(spark.read.text(path))


def stream_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming scan of a growing folder; each file is taken once per checkpoint.

    Lines are numbered inside the micro-batch, by ``number_lines``.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_splits(reader.text(path), F.col("_metadata.file_modification_time"))


def number_lines(df: DataFrame) -> DataFrame:
    """Give lines their place in the input, unless they have it already."""
    if "_pos" in df.columns:
        return df.select("value", "_pos")
    file = F.col("_file") if "_file" in df.columns else F.lit("")
    block = F.col("_block") if "_block" in df.columns else F.lit(0).cast("long")
    time = F.col("_time") if "_time" in df.columns else F.lit(None).cast("timestamp")
    return df.select(
        "value",
        F.struct(
            time.alias("time"),
            file.alias("file"),
            block.alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("_pos"),
    )


def _with_splits(df: DataFrame, time: Column | None = None) -> DataFrame:
    arrival = [] if time is None else [time.alias("_time")]
    return df.select(
        "value",
        *arrival,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


# Nulls stay in the payload and timestamps keep their microseconds.
TO_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_messages(
    df: DataFrame, stream: str | Column, namespace: str | Column | None = None, emitted_at: int = 0
) -> DataFrame:
    """RECORD lines of a table: every column goes into ``data``. Made inside Spark, for tests."""
    descriptor = [_text(stream).alias("stream")]
    if namespace is not None:
        descriptor.append(_text(namespace).alias("namespace"))
    record = F.struct(
        *descriptor,
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("data"),
        F.lit(emitted_at).alias("emitted_at"),
    )
    message = F.struct(F.lit("RECORD").alias("type"), record.alias("record"))
    return df.select(F.to_json(message, TO_JSON_OPTIONS).alias("value"))


def to_stream_states(
    df: DataFrame, state: Column, stream: str | Column, namespace: str | Column | None = None
) -> DataFrame:
    """STATE lines of type STREAM, one per row; ``state`` is a struct, or NULL to reset."""
    descriptor = [_text(stream).alias("name")]
    if namespace is not None:
        descriptor.append(_text(namespace).alias("namespace"))
    body = F.struct(
        F.lit("STREAM").alias("type"),
        F.struct(
            F.struct(*descriptor).alias("stream_descriptor"), state.alias("stream_state")
        ).alias("stream"),
    )
    return _state_lines(df, body)


def to_global_states(df: DataFrame, shared_state: Column, stream_states: Column) -> DataFrame:
    """STATE lines of type GLOBAL, one per row."""
    body = F.struct(
        F.lit("GLOBAL").alias("type"),
        F.struct(
            shared_state.alias("shared_state"), stream_states.alias("stream_states")
        ).alias("global"),
    )
    return _state_lines(df, body)


def _state_lines(df: DataFrame, body: Column) -> DataFrame:
    message = F.struct(F.lit("STATE").alias("type"), body.alias("state"))
    return df.select(F.to_json(message, TO_JSON_OPTIONS).alias("value"))


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value
