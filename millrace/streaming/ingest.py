"""The sync job over a growing folder of message files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.catalog import SyncConfig, selected_streams
from millrace.plans.ingest import ingest
from millrace.sources.messages import stream_messages


def ingest_stream(
    spark: SparkSession,
    path: str,
    warehouse: str,
    catalog: dict | str,
    checkpoint: str,
    config: SyncConfig | None = None,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Load each new file once, one sync per micro-batch.

    Without ``processing_time`` the query takes what is there and stops. A batch that is run again
    after a failure is skipped by the tables that have it: their commit rows hold the id of the query, which
    lives in its checkpoint, and the batch number. A batch with a state but no records of a stream stores the
    state all the same, so the size of batches makes no difference. Overwrite streams are refused, since only
    the last batch would stay.
    """
    config = config or SyncConfig()
    catalog = json.loads(catalog) if isinstance(catalog, str) else catalog
    for stream in selected_streams(catalog, config):
        if stream.mode == "overwrite":
            raise ValueError(f"Stream {stream.descriptor.name} overwrites and cannot be streamed.")

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest(session, batch, warehouse, catalog, config, f"{query}#{batch_id}", keep_states=True)

    writer = (
        stream_messages(spark, path, max_files_per_trigger)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
    )
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    return writer.trigger(availableNow=True).start()
