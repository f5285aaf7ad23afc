"""The last states of a stream of messages, kept in Spark's state store.

The state store holds one line per source stream and one GLOBAL line, the last to have arrived. It lives in the query's
checkpoint, so a query that was stopped goes on from what it knew. Each micro-batch hands over the states it has
changed, as Parquet under its number; a batch that is run again after a failure writes the same folder again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.envelope import MALFORMED, envelope_columns, parse_json, require, well_formed
from millrace.session import path_exists
from millrace.sources.messages import stream_messages

KEYS = ["state_kind", "stream", "namespace"]
UPDATES = "state_kind string, stream string, namespace string, line string, _batch long"


def _numbered(batches):
    """Give the lines of a task their order. Spark has no row numbers in streams; only STATE lines come here."""
    line = 0
    for batch in batches:
        numbers = pa.array(range(line, line + batch.num_rows), pa.int64())
        line += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], [*batch.schema.names, "_line"])


def streaming_last_states(lines: DataFrame) -> DataFrame:
    """The last STATE line of each kind and stream of a streaming frame of lines, to be written in update mode.

    Lines come by the time their file was last written, its path, split and line. A malformed STATE line ends the query.
    """
    shaped = lines.where("startswith(value, '{') AND endswith(value, '}') AND contains(value, 'STATE')")
    numbered = shaped.select("value", "_time", "_file", "_block").mapInArrow(_numbered, "value string, _time timestamp, _file string, _block long, _line long")
    place = F.struct(F.col("_time").alias("time"), F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_line").alias("line"))
    parsed = numbered.select("value", place.alias("_pos"), parse_json(None).alias("_parsed"))
    columns = [f"{text} AS {name}" for name, text in envelope_columns("_parsed").items()]
    known = parsed.where(require(well_formed("_parsed", has_data=False), MALFORMED)).selectExpr("value", "_pos", *columns)
    known = known.where("kind = 'STATE' AND state_kind IN ('GLOBAL', 'STREAM')")
    return known.groupBy(*KEYS).agg(F.max_by("value", "_pos").alias("line"))


def last_states_stream(
    spark: SparkSession, path: str, target: str, checkpoint: str, max_files_per_trigger: int | None = None, processing_time: str | None = None
) -> StreamingQuery:
    """Follow a folder of message files and write changed states under ``target``.

    Without ``processing_time`` the query takes what is there and stops.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # At most one row per source stream.
        batch.coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}/_batch={batch_id}")

    writer = (
        streaming_last_states(stream_messages(spark, path, max_files_per_trigger))
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    return writer.trigger(availableNow=True).start()


def read_last_states(spark: SparkSession, target: str) -> DataFrame:
    """(state_kind, stream, namespace, line) as of the last batch."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], UPDATES).drop("_batch")
    # Folders start with an underscore only in their label; the path itself is listed as a partition.
    updates = spark.read.schema(UPDATES).option("basePath", target).parquet(f"{target.rstrip('/')}/_batch=*")
    return updates.groupBy(*KEYS).agg(F.max_by("line", "_batch").alias("line"))
