"""Loads connector-protocol messages into versioned Parquet tables with Spark."""

from millrace.functions.jsonschema import prune_change_columns, to_struct
from millrace.functions.checks import type_check
from millrace.functions.transforms import partition_columns
from millrace.operators.envelope import (
    Descriptor,
    judge_lines,
    parse_envelope,
    records,
    rejected_lines,
    route,
    states,
    unknown_streams,
)
from millrace.operators.records import (
    check_keywords,
    decode,
    keyword_report,
    undeclared_fields,
    validate,
    validation_report,
)
from millrace.operators.sinks import Commit, append, create_table, overwrite
from millrace.operators.state import (
    last_global_state,
    last_stream_states,
    resolve_states,
    table_states,
)
from millrace.plans.catalog import StreamConfig, SyncConfig, configure_catalog
from millrace.plans.ingest import create_tables, generate_state, ingest
from millrace.sources.messages import (
    scan_messages,
    stream_messages,
    to_global_states,
    to_messages,
    to_stream_states,
)
from millrace.sources.tables import Identifier, read_table, table_history
from millrace.streaming.ingest import ingest_stream
from millrace.streaming.states import last_states_stream, read_last_states, streaming_last_states

__all__ = [
    "Commit",
    "Descriptor",
    "Identifier",
    "StreamConfig",
    "SyncConfig",
    "append",
    "check_keywords",
    "configure_catalog",
    "create_table",
    "create_tables",
    "decode",
    "generate_state",
    "ingest",
    "ingest_stream",
    "judge_lines",
    "keyword_report",
    "last_global_state",
    "last_states_stream",
    "last_stream_states",
    "overwrite",
    "parse_envelope",
    "partition_columns",
    "prune_change_columns",
    "read_last_states",
    "read_table",
    "records",
    "rejected_lines",
    "resolve_states",
    "route",
    "scan_messages",
    "states",
    "stream_messages",
    "streaming_last_states",
    "table_history",
    "table_states",
    "to_global_states",
    "to_messages",
    "to_stream_states",
    "to_struct",
    "type_check",
    "undeclared_fields",
    "unknown_streams",
    "validate",
    "validation_report",
]
