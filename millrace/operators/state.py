"""Resume states: the last one in input order wins, per stream and for the whole source.

STATE lines are carried as raw text, since reading a state to columns and writing it again would
change its numbers. Only the winning lines, at most one per stream and one GLOBAL, reach the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.operators.envelope import Descriptor, envelope_columns, message_lines, once, parse_json
from millrace.sources.tables import Identifier, last_known, read_commits


@dataclass(frozen=True)
class ResolvedState:
    """Canonical state texts to store with a stream; None leaves the stored one as it is."""

    shared_state: str | None = None
    stream_state: str | None = None


def last_line(state_kind: str) -> Column:
    """Aggregate: the last STATE line of a kind in input order."""
    found = f"state_kind = '{state_kind}'"
    return F.expr(f"max_by(if({found}, value, NULL), if({found}, _pos, NULL))")


def fetch_state(lines: DataFrame, state_kind: str, place: Row) -> str | None:
    """The last STATE line of a kind, of which only the place is known: one split of one file is read for it.

    Lines of a frame without files are read once more; only its lines of that kind are looked at.
    """
    if "_file" in lines.columns:
        lines = lines.where((F.col("_file") == place["file"]) & (F.col("_block") == place["block"]))
    elif "_pos" in lines.columns:
        lines = lines.where((F.col("_pos.file") == place["file"]) & (F.col("_pos.block") == place["block"]))
    parsed = message_lines(lines).where(F.contains("value", F.lit("STATE"))).select("value", "_pos", once(parse_json(None)).alias("_parsed"))
    kind = envelope_columns("_parsed")["state_kind"]
    return parsed.selectExpr("value", "_pos", f"{kind} AS state_kind").agg(last_line(state_kind).alias("line")).first()["line"]


def last_global_state(df: DataFrame) -> DataFrame:
    """The last GLOBAL state line, as one row with ``line``; NULL when there is none."""
    return df.agg(last_line("GLOBAL").alias("line"))


def last_stream_states(df: DataFrame) -> DataFrame:
    """The last STREAM state line of each stream."""
    return (
        df.where(F.col("state_kind") == "STREAM")
        .groupBy("stream", "namespace")
        .agg(F.max_by("value", "_pos").alias("line"))
    )


def collect_states(df: DataFrame) -> tuple[str | None, dict[Descriptor, str]]:
    """The winning GLOBAL line and the winning STREAM line per stream, in one job.

    A GLOBAL state has no descriptor, so it forms one group of its own.
    """
    winners = (
        df.where(F.col("state_kind").isin("GLOBAL", "STREAM"))
        .groupBy("state_kind", "stream", "namespace")
        .agg(F.max_by("value", "_pos").alias("line"))
        .collect()
    )
    global_line = next((w["line"] for w in winners if w["state_kind"] == "GLOBAL"), None)
    stream_lines = {
        Descriptor(w["stream"], w["namespace"]): w["line"]
        for w in winners
        if w["state_kind"] == "STREAM"
    }
    return global_line, stream_lines


def canonical(value: object) -> str | None:
    """State text as stored: compact, keys sorted. JSON null counts as no state."""
    if value is None:
        return None
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def resolve_states(
    global_line: str | None, stream_lines: dict[Descriptor, str], descriptors: list[Descriptor]
) -> dict[Descriptor, ResolvedState]:
    """The states to store with each stream.

    The GLOBAL shared state goes to every stream. A stream's own state comes from its last STREAM
    message, or from its part of the GLOBAL one if that message had none or never came.
    """
    body = {}
    if global_line:
        body = json.loads(global_line)["state"].get("global")
        if not isinstance(body, dict):
            raise ValueError(f"Malformed GLOBAL state: {global_line}")
    shared = canonical(body.get("shared_state"))
    parts: dict[Descriptor, object] = {}
    for part in body.get("stream_states") or []:
        key = part["stream_descriptor"]
        parts.setdefault(
            Descriptor(key["name"], key.get("namespace")), part.get("stream_state")
        )
    resolved = {}
    for descriptor in descriptors:
        own = None
        if descriptor in stream_lines:
            own = json.loads(stream_lines[descriptor])["state"]["stream"].get("stream_state")
        if own is None:
            own = parts.get(descriptor)
        resolved[descriptor] = ResolvedState(shared, canonical(own))
    return resolved


def table_states(
    spark: SparkSession, warehouse: str, idents: list[str | Identifier]
) -> DataFrame:
    """The states stored with tables, one row per table, from one scan of their commit rows."""
    idents = [Identifier.of(ident) for ident in idents]
    if not idents:
        raise ValueError("No tables to read states of.")
    return (
        read_commits(spark, warehouse, idents)
        .groupBy("namespace", "name")
        .agg(
            last_known("shared_state").alias("shared_state"),
            last_known("stream_state").alias("stream_state"),
        )
    )


def state_messages(rows: list, order: list[Identifier]) -> list[dict]:
    """State messages from stored states: one GLOBAL if there is a shared state, else one per stream.

    Descriptors have the namespace of the table, also where the source gave none. Of several shared
    states the first in catalog order counts.
    """
    found = {Identifier(row["namespace"], row["name"]): row for row in rows}
    streams = []
    shared = None
    for ident in order:
        row = found[ident]
        if shared is None:
            shared = row["shared_state"]
        if row["stream_state"] is not None:
            streams.append(
                {
                    "stream_descriptor": {"name": ident.name, "namespace": ident.namespace},
                    "stream_state": json.loads(row["stream_state"]),
                }
            )
    if shared is not None:
        body = {"shared_state": json.loads(shared), "stream_states": streams}
        return [{"type": "GLOBAL", "global": body}]
    return [{"type": "STREAM", "stream": stream} for stream in streams]
