"""Hard-negative mining by a vertical scan of embeddings with branch-and-bound on the dimensions (BOND).

An anchor's positives are the rows of its label with the largest inner products, and a positive's hard negatives are
the best rows of other labels whose score lies between a share of the positive's score and that score.

**Layout.** Rows are dealt to shards of bounded size, and anchors to blocks; a task holds one shard as one array for each
dimension, and one block. **Scan.** An anchor reads the dimensions in descending order of its own magnitudes, some at a time,
for the rows whose bit is still set. After each step, what the dimensions not yet read can still add is between sums of their
smallest and largest contributions, from each dimension's least and greatest value in the shard. For positives, rows
whose upper bound is below the k-th best lower bound lose their bit. For negatives, a row keeps its bit while it may
lie in some window and may be among that window's best, given the rows that surely lie in it. Rows left when all dimensions
are read have exact scores. Shards' best are merged by Spark; nothing is capped, and the order (score, then smaller id) is exact.

Scaled entries are floor(256 * x), held to +-2^62. Scores are exact: in doubles where all sums are whole numbers below
2^53, in 64-bit integers where these hold them, in unbounded integers else; a score beyond 64 bits is returned as null.
Defined results: rows with a null id, label or vector, an empty vector, or a null or non-finite entry take no part. Equal
rows (id, label, vector) are one; rows of one id are never partners of each other, and of several anchors with one id each
is an anchor of its own (``anchor_no``). Vectors of different lengths never meet. An anchor with a positive score of 0
has the window of exactly 0; with a negative one the window is empty. Columns besides the three play no part.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
LOW, HIGH, OF = 80, 100, 100  # LOW * positive <= OF * negative <= HIGH * positive
SHARD_ROWS, BLOCK_ROWS, STEP = 16384, 4096, 8


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows that take part, each once."""
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(finite).distinct()


def scaled_matrix(column: pa.Array, scale: int = SCALE) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    return np.clip(x, -(2.0**62), 2.0**62).astype(np.int64).reshape(len(column), -1)


class Shard:
    """The vertical layout: one contiguous array for each dimension, with its least and greatest value."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, reach: int):
        """``reach``: the largest magnitude in the anchors that will ask; it decides the arithmetic."""
        largest = max(abs(int(matrix.min())), abs(int(matrix.max()))) if matrix.size else 0
        bound = largest * reach * max(matrix.shape[1], 1)
        self.kind = np.float64 if bound < 1 << 52 else np.int64 if bound < 1 << 62 else object
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(matrix.T).astype(self.kind)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, keep, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap ``alive`` that outlast all dimensions, and their scores. ``keep(rows, least, most)`` tells which stay."""
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        anchor = anchor.astype(self.kind)
        ends = np.stack([anchor * self.low, anchor * self.high])
        least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
        after_least = np.append(np.cumsum(least[::-1])[::-1], 0)
        after_most = np.append(np.cumsum(most[::-1])[::-1], 0)
        rows = np.flatnonzero(alive)
        score = np.zeros(len(rows), dtype=self.kind)
        for at in range(0, len(order), step):
            if not len(rows):
                break
            dims = order[at : at + step]
            whole = len(rows) == self.columns.shape[1]
            score = score + anchor[dims] @ (self.columns[dims] if whole else self.columns[np.ix_(dims, rows)])
            to = min(at + step, len(order))
            stay = keep(rows, score + after_least[to], score + after_most[to])
            rows, score = rows[stay], score[stay]
        return rows, score

    def best(self, label: int, own_id: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best other rows of the label."""

        def keep(rows, least, most):
            if len(rows) <= k:
                return np.ones(len(rows), dtype=bool)
            return most >= np.sort(least)[-k]

        rows, score = self.scan(anchor, (self.labels == label) & (self.ids != own_id), keep)
        return self._first(rows, score, k)

    def _first(self, rows: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[rows], -score))[:k]
        return rows[order], score[order]

    def within(self, label: int, own_id: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int):
        """For each window (least, greatest score) its k best rows of other labels."""

        def keep(rows, least, most):
            stay = np.zeros(len(rows), dtype=bool)
            for low, high in windows:
                may = (most >= low) & (least <= high)
                sure = least[(least >= low) & (most <= high)]
                if len(sure) >= k:
                    may &= most >= np.sort(sure)[-k]
                stay |= may
            return stay

        rows, score = self.scan(anchor, (self.labels != label) & (self.ids != own_id), keep)
        for low, high in windows:
            inside = (score >= low) & (score <= high)
            yield self._first(rows[inside], score[inside], k)


def _decimals(values: list) -> pa.Array:
    """Whole numbers; the order needs them exactly even where they are beyond 64 bits."""
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _shard_of(left: pa.Table, right: pa.Table) -> tuple[Shard, np.ndarray]:
    asked = scaled_matrix(right.column("v"))
    reach = max(abs(int(asked.min())), abs(int(asked.max()))) if asked.size else 0
    return Shard(left.column("vec_id").to_numpy(), left.column("label").to_numpy(), scaled_matrix(left.column("v")), reach), asked


def window_of(score: int, low: int = LOW, high: int = HIGH, of: int = OF) -> tuple[int, int]:
    """The least and greatest whole score s with low * score <= of * s <= high * score."""
    return -(-low * score // of), high * score // of


KEYS = ["shard", "block", "dims"]


def mine(
    vectors: DataFrame,
    anchors: str = "pmod(vec_id, 100) = 0",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    of: int = OF,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Rows (anchor_no, anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchors`` is a condition on vec_id and label."""
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.keep(usable(vectors, id_col, vec_col, label_col))
    rows = rows.withColumn("dims", F.size("v"))
    asked = scratch.keep(rows.where(anchors).withColumn("anchor_no", F.monotonically_increasing_id()))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Dealt by the row's place, so that equal ids or labels don't meet in one task.
    place = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    points = rows.withColumn("shard", place).withColumn("block", every(blocks)).groupBy(*KEYS)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("anchor_no"), F.lit(blocks)).cast("int"))

    def search(left, right):
        out: list[list] = [[], [], [], []]
        if len(left) and len(right):
            shard, matrix = _shard_of(left, right)
            numbers, ids, labels = (right.column(c).to_numpy() for c in ("anchor_no", "vec_id", "label"))
            for i in range(len(ids)):
                best, score = shard.best(labels[i], ids[i], matrix[i], positives)
                out[0].extend([numbers[i]] * len(best))
                out[1].extend([ids[i]] * len(best))
                out[2].extend(shard.ids[best].tolist())
                out[3].extend(score.tolist())
        numbers, ids, found, scores = out
        return pa.table({"anchor_no": pa.array(numbers, pa.int64()), "anchor_id": pa.array(ids, pa.int64()), "positive_id": pa.array(found, pa.int64()), "p": _decimals(scores)})

    met = points.cogroup(asked.withColumn("shard", every(shards)).groupBy(*KEYS)).applyInArrow(search, "anchor_no long, anchor_id long, positive_id long, p decimal(38,0)")
    ranked = F.row_number().over(Window.partitionBy("anchor_no").orderBy(F.desc("p"), "positive_id"))
    met = scratch.keep(met.withColumn("r", ranked).where(F.col("r") <= positives).drop("r"))
    windows = met.groupBy("anchor_no").agg(F.collect_list(F.struct("positive_id", "p")).alias("windows"))  # at most ``positives`` of each
    wanted = scratch.keep(asked.join(windows, "anchor_no"))

    def resolve(left, right):
        out: list[list] = [[], [], [], [], [], []]
        if len(left) and len(right):
            shard, matrix = _shard_of(left, right)
            numbers, ids, labels = (right.column(c).to_numpy() for c in ("anchor_no", "vec_id", "label"))
            for i, positives_of in enumerate(right.column("windows").to_pylist()):
                bounds = [window_of(int(w["p"]), low, high, of) for w in positives_of]
                for w, (found, score) in zip(positives_of, shard.within(labels[i], ids[i], matrix[i], bounds, negatives)):
                    for column, value in zip(out, (numbers[i], ids[i], w["positive_id"], w["p"])):
                        column.extend([value] * len(found))
                    out[4].extend(shard.ids[found].tolist())
                    out[5].extend(score.tolist())
        numbers, ids, positive, p, found, scores = out
        return pa.table({
            "anchor_no": pa.array(numbers, pa.int64()), "anchor_id": pa.array(ids, pa.int64()), "positive_id": pa.array(positive, pa.int64()),
            "p": pa.array(p, pa.decimal128(38, 0)), "negative_id": pa.array(found, pa.int64()), "s": _decimals(scores),
        })

    schema = "anchor_no long, anchor_id long, positive_id long, p decimal(38,0), negative_id long, s decimal(38,0)"
    hard = points.cogroup(wanted.withColumn("shard", every(shards)).groupBy(*KEYS)).applyInArrow(resolve, schema)
    ranked = F.row_number().over(Window.partitionBy("anchor_no", "positive_id", "p").orderBy(F.desc("s"), "negative_id"))
    hard = hard.withColumn("rank", ranked.cast("int")).where(F.col("rank") <= negatives)
    fits = lambda c: F.expr(f"try_cast({c} AS bigint)")
    return hard.select("anchor_no", "anchor_id", "positive_id", "rank", "negative_id", fits("p").alias("positive_score"), fits("s").alias("negative_score"))
