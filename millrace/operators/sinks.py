"""Table creation, append and overwrite."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import variants as V
from millrace.functions.jsonschema import nullable_type
from millrace.functions.transforms import partition_columns, partition_types, to_folder
from millrace.operators.envelope import require
from millrace.session import create_file, delete_path, enable_time_type
from millrace.sources.tables import (
    MAIN,
    Head,
    Identifier,
    data_path,
    load_head,
    table_exists,
    table_path,
)

MODES = ("append", "overwrite")


@dataclass(frozen=True)
class Written:
    """Data files that no commit shows yet."""

    head: Head
    branch: str
    mode: str
    sync_id: str
    rows: int


@dataclass(frozen=True)
class Commit:
    ident: Identifier
    seq: int
    branch: str
    mode: str
    added_rows: int


def create_table(
    spark: SparkSession,
    warehouse: str,
    ident: str | Identifier,
    schema: T.StructType,
    partition_by: dict[str, str] | None = None,
) -> bool:
    """Create a table unless it exists; an existing one stays as it is. Tells whether it was made."""
    ident = Identifier.of(ident)
    partition_by = partition_by or {}
    partition_columns(schema, partition_by)
    enable_time_type(spark, schema)
    if table_exists(spark, warehouse, ident):
        return False
    return _write_commit(
        spark,
        warehouse,
        ident,
        {
            "seq": 1,
            "branch": MAIN,
            "mode": "create",
            "added_rows": 0,
            "schema_json": schema.json(),
            "partition_by": json.dumps(partition_by),
        },
    )


def append(
    df: DataFrame,
    warehouse: str,
    ident: str | Identifier,
    branch: str = MAIN,
    shared_state: str | None = None,
    stream_state: str | None = None,
) -> Commit | None:
    """Add rows to a branch. With no rows there is no commit."""
    return _sink(df, warehouse, ident, branch, "append", shared_state, stream_state)


def overwrite(
    df: DataFrame,
    warehouse: str,
    ident: str | Identifier,
    branch: str = MAIN,
    shared_state: str | None = None,
    stream_state: str | None = None,
) -> Commit | None:
    """Replace the content of a branch. With no rows there is no commit, and the old rows stay."""
    return _sink(df, warehouse, ident, branch, "overwrite", shared_state, stream_state)


def _sink(df, warehouse, ident, branch, mode, shared_state, stream_state) -> Commit | None:
    head = load_head(df.sparkSession, warehouse, ident, branch, missing_branch_ok=True)
    for field in head.schema:
        good = _has_values(V.name(field.name), field.dataType, field.nullable)
        if good:
            message = V.literal(f"Column {field.name} of table {head.ident} needs a value.")
            df = df.where(require(good, message))
    written = write_files(df, warehouse, head, branch, mode)
    return commit(df.sparkSession, warehouse, written, shared_state, stream_state)


def _has_values(value: str, data_type: T.DataType, nullable: bool, depth: int = 0) -> str:
    """Whether required values are there, at every level; empty if nothing is required. A null column has none."""
    inner = ""
    if isinstance(data_type, T.StructType):
        parts = [_has_values(f"{value}.{V.name(f.name)}", f.dataType, f.nullable, depth) for f in data_type]
        inner = " AND ".join(part for part in parts if part)
    elif isinstance(data_type, T.ArrayType):
        element = f"e{depth}"
        part = _has_values(element, data_type.elementType, data_type.containsNull, depth + 1)
        inner = f"forall({value}, {element} -> {part})" if part else ""
    if isinstance(data_type, T.NullType) or (nullable and not inner):
        return ""
    if nullable:
        return f"({value} IS NULL OR ({inner}))"
    return f"({value} IS NOT NULL AND {inner})" if inner else f"({value} IS NOT NULL)"


def write_files(df: DataFrame, warehouse: str, head: Head, branch: str, mode: str) -> Written:
    """Write the rows as Parquet files of a new sync, counting them on the way.

    Partitioned tables get their rows clustered by partition first, or every task would write a file
    to every partition. The rebalance splits a partition that holds most of the rows by size and puts
    small ones together. The rows are counted behind that shuffle, where a repeated task counts once.
    """
    if mode not in MODES:
        raise ValueError(f"Sync mode {mode} is invalid.")
    sync_id = uuid.uuid4().hex
    path = data_path(warehouse, head, sync_id)
    rows = df.select(
        *(F.col(V.name(f.name)).cast(nullable_type(f.dataType)).alias(f.name) for f in head.schema)
    )
    types = {f.name: f.dataType for f in partition_types(head.schema, head.partition_by)}
    partitions = {
        name: to_folder(value, types[name])
        for name, value in partition_columns(head.schema, head.partition_by).items()
    }
    if partitions:
        rows = rows.withColumns(partitions)
        rows = rows.hint("rebalance", *(F.col(V.name(name)) for name in partitions))
    counted = Observation()
    try:
        (
            rows.observe(counted, F.count(F.lit(1)).alias("n"))
            .write.partitionBy(*partitions)
            .mode("errorifexists")
            .parquet(path)
        )
    except Exception:
        delete_path(df.sparkSession, path)
        raise
    return Written(head, branch, mode, sync_id, counted.get["n"])


def discard(spark: SparkSession, warehouse: str, written: Written) -> None:
    """Delete files that will not be committed."""
    delete_path(spark, data_path(warehouse, written.head, written.sync_id))


def commit(
    spark: SparkSession,
    warehouse: str,
    written: Written,
    shared_state: str | None = None,
    stream_state: str | None = None,
    batch_key: str | None = None,
    keep_states: bool = False,
) -> Commit | None:
    """Show written files and the new states together; states left None stay as they were.

    Without rows there is no commit, unless ``keep_states``: then there is one of states only, if any is given.
    Fails if someone else has committed to the table since its head was read.
    """
    mode = written.mode
    if not written.rows:
        discard(spark, warehouse, written)
        if not keep_states or (shared_state is None and stream_state is None):
            return None
        mode = "state"
    head = written.head
    seq = head.last_seq + 1
    made = _write_commit(
        spark,
        warehouse,
        head.ident,
        {
            "seq": seq,
            "parent": head.seq,
            "branch": written.branch,
            "sync_id": written.sync_id,
            "mode": mode,
            "added_rows": written.rows,
            "shared_state": shared_state,
            "stream_state": stream_state,
            "batch_key": batch_key,
        },
    )
    if not made:
        discard(spark, warehouse, written)
        raise RuntimeError(f"Table {head.ident} has got another commit {seq} meanwhile; this one is not made.")
    return Commit(head.ident, seq, written.branch, mode, written.rows)


def _write_commit(spark: SparkSession, warehouse: str, ident: Identifier, values: dict) -> bool:
    """Make the commit's file, named by its number; false if there is a whole one already."""
    values = {"namespace": ident.namespace, "name": ident.name, **values}
    values["committed_at"] = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
    line = json.dumps({k: v for k, v in values.items() if v is not None}) + "\n"

    def whole(text: str) -> bool:
        try:
            return json.loads(text).get("seq") == values["seq"]
        except (ValueError, AttributeError):
            return False

    return create_file(spark, f"{table_path(warehouse, ident)}/commits/{values['seq']:020d}.json", line, whole)
