"""Tables: Parquet data with a log of commits.

    <warehouse>/<namespace>/<table>/data/_sync_id=<id>/[_p_x=.../]*.parquet
    <warehouse>/<namespace>/<table>/commits/*.json     one row per commit

Data is written first and its commit row last, so a data folder without a commit row is invisible. The
rows a branch shows are those of the commits since its last overwrite. A commit row has a fixed size,
whatever the number of commits before it. Commit files are named by their number and renamed into place only if they are
not there, so of two writers from one head the second fails, and a crash leaves no part of one. The label ``_sync_id`` and those of partitions get
underscores where a column of the table has that name.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.transforms import free_label, from_folder, partition_types
from millrace.session import enable_time_type, path_exists

MAIN = "main"
SYNC_ID = "_sync_id"

COMMIT_SCHEMA = (
    "namespace string, name string, seq long, parent long, branch string, sync_id string, mode string, "
    "added_rows long, schema_json string, partition_by string, shared_state string, "
    "stream_state string, batch_key string, committed_at timestamp"
)


@dataclass(frozen=True)
class Identifier:
    """Name of a table."""

    namespace: str
    name: str

    @classmethod
    def of(cls, ident: "str | Identifier") -> "Identifier":
        if isinstance(ident, Identifier):
            return ident
        namespace, _, name = ident.rpartition(".")
        if not namespace or not name:
            raise ValueError(f"{ident} is not of the form namespace.name.")
        return cls(namespace, name)

    def __str__(self) -> str:
        return f"{self.namespace}.{self.name}"


@dataclass
class Head:
    """What a branch of a table shows."""

    ident: Identifier
    seq: int
    last_seq: int
    schema: T.StructType
    partition_by: dict[str, str]
    live: list[str] = field(default_factory=list)
    shared_state: str | None = None
    stream_state: str | None = None
    has_batch: bool = False


def table_path(warehouse: str, ident: str | Identifier) -> str:
    ident = Identifier.of(ident)
    return "/".join([warehouse.rstrip("/"), _segment(ident.namespace), _segment(ident.name)])


def data_path(warehouse: str, head: "Head", sync_id: str) -> str:
    return f"{table_path(warehouse, head.ident)}/data/{free_label(SYNC_ID, head.schema)}={sync_id}"


def _segment(name: str) -> str:
    """A path segment free of separators and glob characters."""
    return quote(name, safe=" _-").replace(".", "%2E")


def read_commits(spark: SparkSession, warehouse: str, idents: list[Identifier]) -> DataFrame:
    """The commit rows of some tables; a table that does not exist is an error."""
    paths = []
    for ident in idents:
        path = f"{table_path(warehouse, ident)}/commits"
        if not path_exists(spark, path):
            raise LookupError(f"Table {ident} could not be found.")
        paths.append(path)
    # A line that is cut off is no commit.
    return spark.read.schema(COMMIT_SCHEMA).option("mode", "DROPMALFORMED").json(paths).where("seq IS NOT NULL")


def last_known(column: str) -> Column:
    """The last value a commit set; commits that leave it alone have NULL."""
    value = F.col(column)
    return F.max_by(value, F.when(value.isNotNull(), F.col("seq")))


def load_head(
    spark: SparkSession,
    warehouse: str,
    ident: str | Identifier,
    branch: str = MAIN,
    batch_key: str | None = None,
    missing_branch_ok: bool = False,
) -> Head:
    """State of a branch. A branch nobody wrote to yet shows what main shows.

    One job over the commit rows; what reaches the driver is one small row and the ids of the commits.
    """
    ident = Identifier.of(ident)
    commits = read_commits(spark, warehouse, [ident])
    data_commit = F.col("mode").isin("append", "overwrite")
    entry = F.when(data_commit, F.struct("seq", "parent", "branch", "mode", "sync_id"))
    row = commits.agg(
        F.max("seq").alias("last_seq"),
        F.max_by("schema_json", F.when(F.col("schema_json").isNotNull(), F.col("seq"))).alias("schema"),
        last_known("partition_by").alias("partition_by"),
        last_known("shared_state").alias("shared_state"),
        last_known("stream_state").alias("stream_state"),
        F.bool_or(F.col("batch_key") == F.lit(batch_key)).alias("has_batch"),
        F.collect_list(entry).alias("entries"),
    ).first()
    if row["schema"] is None:
        raise LookupError(f"Table {ident} could not be found.")
    schema = T.StructType.fromJson(json.loads(row["schema"]))
    enable_time_type(spark, schema)
    entries = sorted(row["entries"], key=lambda e: e["seq"])
    own = [e for e in entries if e["branch"] == branch]
    if branch == MAIN:
        lineage = own
    elif own:
        fork = own[0]["parent"]
        lineage = [e for e in entries if e["branch"] == MAIN and e["seq"] <= fork] + own
    elif missing_branch_ok:
        lineage = [e for e in entries if e["branch"] == MAIN]
    else:
        raise LookupError(f"Branch {branch} of table {ident} could not be found.")
    start = max((i for i, e in enumerate(lineage) if e["mode"] == "overwrite"), default=0)
    return Head(
        ident=ident,
        seq=lineage[-1]["seq"] if lineage else 1,
        last_seq=row["last_seq"],
        schema=schema,
        partition_by=json.loads(row["partition_by"] or "{}"),
        live=[e["sync_id"] for e in lineage[start:]],
        shared_state=row["shared_state"],
        stream_state=row["stream_state"],
        has_batch=bool(row["has_batch"]),
    )


def read_table(
    spark: SparkSession,
    warehouse: str,
    ident: str | Identifier,
    branch: str = MAIN,
    with_partitions: bool = False,
) -> DataFrame:
    """The rows of a table on a branch.

    Only the folders of live commits are listed. With ``with_partitions`` the partition columns are
    there too; filters on them prune folders.
    """
    head = load_head(spark, warehouse, ident, branch)
    partitions = partition_types(head.schema, head.partition_by)
    columns = [F.col(f"`{f.name}`") for f in head.schema]
    if with_partitions:
        columns += [from_folder(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in partitions]
    full = T.StructType(head.schema.fields + partitions.fields).add(free_label(SYNC_ID, head.schema), T.StringType())
    if not head.live:
        return spark.createDataFrame([], full).select(*columns)
    data = f"{table_path(warehouse, ident)}/data"
    return (
        spark.read.schema(full)
        .option("basePath", data)
        .parquet(*(data_path(warehouse, head, sync_id) for sync_id in head.live))
        .select(*columns)
    )


def table_history(spark: SparkSession, warehouse: str, ident: str | Identifier) -> DataFrame:
    """The commits of a table: order, branch, mode, rows added, and states set."""
    return read_commits(spark, warehouse, [Identifier.of(ident)]).select(
        "seq",
        "branch",
        "mode",
        "added_rows",
        "shared_state",
        "stream_state",
        "batch_key",
        "committed_at",
    )


def table_exists(spark: SparkSession, warehouse: str, ident: str | Identifier) -> bool:
    try:
        return not read_commits(spark, warehouse, [Identifier.of(ident)]).isEmpty()
    except LookupError:
        return False
