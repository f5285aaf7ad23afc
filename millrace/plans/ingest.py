"""The sync job: message lines in, one commit per stream out.

With a single stream the lines are read once: parsed, checked, decoded and written in one pass, the
places of the last states being picked up on the way; their lines are then fetched from the files they are in. With several, the lines are first split by stream into a
staging table next to the warehouse, so that each stream's own job reads its lines and no others;
splitting parses the envelope only. No step shuffles records, except for partitioned tables.

All streams are written before any is committed, and a failure until then commits none. A failure while
committing leaves the tables committed by then as they are; what the others wrote is deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.jsonschema import to_struct
from millrace.operators.envelope import (
    CORRUPT,
    IS_USED,
    MALFORMED,
    NAMES_STREAM,
    NOT_FOUND,
    SAME_STREAM,
    Descriptor,
    descriptor_table,
    envelope_columns,
    matches,
    message_lines,
    once,
    parse_json,
    reason,
    require,
    well_formed,
)
from millrace.operators.load import load_records, parse_payload
from millrace.operators.sinks import Commit, Written, commit, create_table, discard, write_files
from millrace.operators.state import (
    ResolvedState,
    collect_states,
    fetch_state,
    resolve_states,
    state_messages,
    table_states,
)
from millrace.plans.catalog import SyncConfig, Stream, known_descriptors, selected_streams
from millrace.session import allow_duplicate_keys, delete_path
from millrace.sources.messages import scan_splits
from millrace.sources.tables import Head, load_head

In = TypeVar("In")
Out = TypeVar("Out")

# Route of STATE lines in the staging table; records have their stream's place in the catalog.
STATE_ROUTE = -1
# Route of malformed lines where they are kept; ``state_kind`` has the reason.
REJECT_ROUTE = -2

STAGED_SCHEMA = (
    "value string, _pos struct<time:timestamp,file:string,block:bigint,line:bigint>, state_kind string, "
    "stream string, namespace string, _route int"
)


def create_tables(
    spark: SparkSession, warehouse: str, catalog: dict, config: SyncConfig | None = None
) -> dict[str, bool]:
    """Create the tables of the selected streams that do not exist yet."""
    config = config or SyncConfig()
    streams = selected_streams(catalog, config)
    made = _in_parallel(
        spark,
        config,
        streams,
        lambda s: create_table(
            spark, warehouse, s.ident, to_struct(s.json_schema, config.wide_numbers), s.partition_by
        ),
    )
    return {str(stream.ident): flag for stream, flag in zip(streams, made)}


def ingest(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    warehouse: str,
    catalog: dict | str,
    config: SyncConfig | None = None,
    batch_key: str | None = None,
    keep_states: bool = False,
) -> list[Commit]:
    """Load messages into tables.

    ``source`` is a path or a DataFrame of lines in ``value``. ``catalog`` is a configured catalog, or
    a discovered one, which is configured first. A stream with no records makes no commit, unless
    ``keep_states`` and there is a state for it. A table that has a commit with this ``batch_key`` already is
    left alone.
    """
    config = config or SyncConfig()
    catalog = json.loads(catalog) if isinstance(catalog, str) else catalog
    allow_duplicate_keys(spark)
    known = known_descriptors(catalog)
    streams = selected_streams(catalog, config)
    lines = source if isinstance(source, DataFrame) else scan_splits(spark, source)
    heads = _in_parallel(
        spark, config, streams, lambda s: _ensure_table(spark, warehouse, s, config, batch_key)
    )
    work = [(s, h) for s, h in zip(streams, heads) if not h.has_batch]
    if not work:
        return []
    if len(known) == 1 and not config.rejects:
        written, states = _load_one(lines, warehouse, *work[0], config)
    else:
        written, states = _load_many(spark, lines, warehouse, work, known, config)

    def finish(item: Written) -> Commit | None:
        state = states[item.head.ident]
        open_items.remove(item)
        return commit(
            spark, warehouse, item, state.shared_state, state.stream_state, batch_key, keep_states
        )

    open_items = list(written)
    try:
        return [c for c in _in_parallel(spark, config, written, finish) if c is not None]
    except Exception:
        for item in list(open_items):
            discard(spark, warehouse, item)
        raise


def generate_state(
    spark: SparkSession, warehouse: str, catalog: dict | str, config: SyncConfig | None = None
) -> list[dict]:
    """The state messages to hand to the source, from the states stored with the tables."""
    config = config or SyncConfig()
    catalog = json.loads(catalog) if isinstance(catalog, str) else catalog
    idents = [s.ident for s in selected_streams(catalog, config)]
    if not idents:
        return []
    return state_messages(table_states(spark, warehouse, idents).collect(), idents)


def _ensure_table(
    spark: SparkSession, warehouse: str, stream: Stream, config: SyncConfig, batch_key: str | None
) -> Head:
    def load() -> Head:
        return load_head(
            spark, warehouse, stream.ident, config.branch, batch_key, missing_branch_ok=True
        )

    try:
        return load()
    except LookupError:
        struct = to_struct(stream.json_schema, config.wide_numbers)
        create_table(spark, warehouse, stream.ident, struct, stream.partition_by)
        return load()


def _load_one(
    lines: DataFrame, warehouse: str, stream: Stream, head: Head, config: SyncConfig
) -> tuple[list[Written], dict]:
    """One pass for a catalog of one stream."""
    # A record that does not fit its stream's types may still be a well-formed message.
    unsure = (
        f"_parsed.{CORRUPT} IS NOT NULL"
        " OR (_parsed.m.type = 'RECORD' AND _parsed.m.record.data IS NULL)"
    )
    parsed = (
        message_lines(lines)
        .select("value", "_pos", parse_payload(stream.json_schema, head.schema).alias("_parsed"))
        .withColumn("_exact", once(F.when(F.expr(unsure), parse_json(T.VariantType()))))
    )
    fast, exact = envelope_columns("_parsed"), envelope_columns("_exact")
    good = f"if(_exact IS NULL, {well_formed('_parsed')}, {well_formed('_exact')})"
    messages = parsed.where(require(good, MALFORMED)).select(
        "value",
        "_pos",
        "_parsed",
        *(once(f"if(_exact IS NULL, {fast[n]}, {exact[n]})").alias(n) for n in fast),
    )
    messages = messages.where(
        require(f"NOT {NAMES_STREAM} OR {matches(stream.descriptor)}", NOT_FOUND)
    )
    seen = Observation()
    messages = messages.observe(
        seen,
        *(F.expr(f"max(if(state_kind = '{kind}', _pos, NULL))").alias(kind) for kind in ("GLOBAL", "STREAM")),
    )
    rows = load_records(messages.where("kind = 'RECORD'"), stream.json_schema, head.schema, config.keywords)
    written = write_files(rows, warehouse, head, config.branch, stream.mode)
    try:
        last = {kind: fetch_state(lines, kind, place) for kind, place in seen.get.items() if place is not None}
        own_lines = {stream.descriptor: last["STREAM"]} if "STREAM" in last else {}
        resolved = resolve_states(last.get("GLOBAL"), own_lines, [stream.descriptor])
    except Exception:
        discard(lines.sparkSession, warehouse, written)
        raise
    return [written], {stream.ident: resolved[stream.descriptor]}


def _load_many(
    spark: SparkSession,
    lines: DataFrame,
    warehouse: str,
    work: list[tuple[Stream, Head]],
    known: list[Descriptor],
    config: SyncConfig,
) -> tuple[list[Written], dict]:
    """Split the lines by stream, then one job per stream."""
    staging = f"{warehouse.rstrip('/')}/.staging/{uuid.uuid4().hex}"
    routes = {stream.descriptor: known.index(stream.descriptor) for stream, _ in work}
    written: list[Written] = []
    try:
        split_lines(lines, known, list(routes.values()), config.rejects is not None).write.partitionBy("_route").option(
            "compression", "zstd"
        ).parquet(staging)
        staged = spark.read.schema(STAGED_SCHEMA).parquet(staging)

        def write(item: tuple[Stream, Head]) -> Written:
            stream, head = item
            own = staged.where(F.col("_route") == routes[stream.descriptor]).select(
                "value",
                "_pos",
                parse_payload(stream.json_schema, head.schema).alias("_parsed"),
            )
            rows = load_records(own, stream.json_schema, head.schema, config.keywords)
            done = write_files(rows, warehouse, head, config.branch, stream.mode)
            written.append(done)
            return done

        _in_parallel(spark, config, work, write)
        winners = collect_states(staged.where(F.col("_route") == STATE_ROUTE))
        resolved = resolve_states(*winners, [stream.descriptor for stream, _ in work])
        if config.rejects:
            # A copy of the staged rows, so the input is read and judged once.
            bad = staged.where(F.col("_route") == REJECT_ROUTE)
            place = [F.col(f"_pos.{c}").alias(c) for c in ("file", "block", "line")]
            bad.select(*place, "value", F.col("state_kind").alias("reason")).write.mode("append").parquet(config.rejects)
    except Exception:
        for done in written:
            discard(spark, warehouse, done)
        raise
    finally:
        delete_path(spark, staging)
    states: dict[object, ResolvedState] = {
        stream.ident: resolved[stream.descriptor] for stream, _ in work
    }
    return written, states


def split_lines(lines: DataFrame, known: list[Descriptor], wanted: list[int], keep_malformed: bool = False) -> DataFrame:
    """Lines with the route they go to: STATE lines and the records of wanted streams.

    A stream the catalog does not have ends the job, and so does a malformed line unless they are kept: then it has a route of its own.
    """
    parsed = message_lines(lines).select(
        "value", "_pos", once(parse_json(T.VariantType() if keep_malformed else None)).alias("_parsed")
    )
    columns = [f"{text} AS {name}" for name, text in envelope_columns("_parsed").items()]
    if keep_malformed:
        parsed = parsed.withColumn("_reason", once(reason("_parsed")))
    else:
        parsed = parsed.where(require(well_formed("_parsed", has_data=False), MALFORMED)).withColumn("_reason", F.lit(None).cast("string"))
    messages = parsed.selectExpr("value", "_pos", "_reason", *columns)
    table = descriptor_table(lines.sparkSession, known)
    routes = ", ".join(str(route) for route in wanted)
    is_state = "_reason IS NULL AND kind = 'STATE'"
    return (
        messages.where(f"_reason IS NOT NULL OR {IS_USED}")
        .join(table, F.expr(SAME_STREAM), "left")
        .where(require(f"_reason IS NOT NULL OR NOT {NAMES_STREAM} OR _route IS NOT NULL", NOT_FOUND))
        .where(f"_reason IS NOT NULL OR kind = 'STATE' OR _route IN ({routes})")
        .selectExpr(
            "value",
            "_pos",
            "coalesce(_reason, state_kind) AS state_kind",
            f"if({is_state}, stream, NULL) AS stream",
            f"if({is_state}, namespace, NULL) AS namespace",
            f"CASE WHEN _reason IS NOT NULL THEN {REJECT_ROUTE} WHEN kind = 'STATE' THEN {STATE_ROUTE} ELSE _route END AS _route",
        )
    )


def _in_parallel(
    spark: SparkSession, config: SyncConfig, items: list[In], job: Callable[[In], Out]
) -> list[Out]:
    """Run one Spark job per item side by side; the first failure interrupts the others."""
    if len(items) <= 1:
        return [job(item) for item in items]
    tag = f"sync-{uuid.uuid4().hex}"

    @inheritable_thread_target(spark)
    def tagged(item: In) -> Out:
        spark.addTag(tag)
        try:
            return job(item)
        finally:
            spark.removeTag(tag)

    with ThreadPoolExecutor(max_workers=min(config.parallel_streams, len(items))) as pool:
        futures = [pool.submit(tagged, item) for item in items]
        try:
            return [future.result() for future in futures]
        except Exception:
            for future in futures:
                future.cancel()
            spark.interruptTag(tag)
            raise
