"""Approximate nearest neighbours by a hash-prefix forest: largest inner product, in double precision.

**Index.** Vectors are dealt to shards of bounded size. In a shard each tree hashes a vector to a long bit string, the signs
of random projections, and keeps the strings as a sorted array. For inner products the vectors get one more
component that makes all lengths equal, so that the angle orders them as the inner product does.
**Search.** A query descends each tree to its longest-prefix matches: a range of the sorted array. From the level at
which all trees together have enough, the trees ascend together a bit at a time, and new candidates are scored
exactly. A query ascends until vectors as near as its k-th best would have been met with probability ``target``, which
follows from the angle, the level and the number of trees; no candidates are capped. Shards' best are merged.

Queries in blocks meet shards, so a task holds one shard and one block whatever the sizes are.
Equal vectors are one entry of the forest with all their ids. Vectors that are null, zero or hold null or non-finite
components take no part; vectors of different lengths never meet. Rows with a null id take no part; a row never is
its own query's neighbour, told by its id. Ties go to the smaller id. Columns besides id and vector play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREES, BITS, TARGET = 24, 32, 0.97
SHARD_ROWS, BLOCK_ROWS = 16384, 4096


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v, dims) of the rows that take part."""
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where("vec_id IS NOT NULL AND v IS NOT NULL").where(finite & F.exists("v", lambda x: x != 0)).withColumn("dims", F.size("v"))


class Forest:
    """The sorted arrays of a shard."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int = 11):
        self.vectors, self.trees, self.bits = vectors, trees, bits
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.longest = float(norms.max())
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(self.longest**2 - norms**2, 0))])
        self.planes = np.random.default_rng(seed).standard_normal((lifted.shape[1], trees * bits))
        codes = self._codes(lifted)
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, axis=0)

    def _codes(self, lifted: np.ndarray) -> np.ndarray:
        signs = (lifted @ self.planes > 0).reshape(len(lifted), self.trees, self.bits)
        return signs @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))

    def search(self, queries: np.ndarray, k: int, target: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query, places and scores of the k best it met, and of all that tie with the last."""
        n, levels = len(self.vectors), self.bits + 1
        codes = self._codes(np.column_stack([queries, np.zeros(len(queries))]))
        low = np.zeros((levels, len(queries), self.trees), dtype=np.int32)
        high = np.full_like(low, n)
        for depth in range(1, levels):
            prefix = codes >> (self.bits - depth)
            for t in range(self.trees):
                low[depth, :, t] = np.searchsorted(self.codes[:, t], prefix[:, t] << (self.bits - depth))
                high[depth, :, t] = np.searchsorted(self.codes[:, t], (prefix[:, t] + 1) << (self.bits - depth))
        met = (high - low).sum(axis=2)
        out = []
        for q, query in enumerate(queries):
            seen = np.zeros(n, dtype=bool)
            scores, count, top = np.full(n, -np.inf), 0, np.zeros(0)
            size = self.longest * float(np.sqrt(query @ query))
            start, enough, whole = int(np.flatnonzero(met[:, q] >= min(k, n))[-1]), min(k, n), None
            for depth in range(start, -1, -1):
                fresh = np.zeros(n, dtype=bool)
                if depth:
                    parts = [self.order[low[depth, q, t] : high[depth, q, t], t] for t in range(self.trees)]
                    fresh[np.concatenate(parts)] = True
                else:
                    fresh[:] = True
                fresh &= ~seen
                new = np.flatnonzero(fresh)
                if len(new):
                    seen |= fresh
                    # Many rows are scored faster all together than gathered.
                    if whole is None and len(new) > n // 16:
                        whole = self.vectors @ query
                    scores[new] = self.vectors[new] @ query if whole is None else whole[new]
                    count += len(new)
                    top = np.concatenate([top, scores[new]])
                    if len(top) > enough:
                        top = np.partition(top, len(top) - enough)[len(top) - enough :]
                if not depth or count < enough:
                    continue
                agree = 1 - np.arccos(np.clip(top.min() / size, -1, 1)) / np.pi
                if 1 - (1 - agree**depth) ** self.trees >= target:
                    break
            # The best and all that tie with the last of them.
            places = np.flatnonzero(scores >= top.min())
            out.append((places, scores[places]))
        return out


FOUND = "query_id long, vec_id long, score double"


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    trees: int = TREES,
    bits: int = BITS,
    target: float = TARGET,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score), nearest first."""
    points, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col)
    shards = max(1, -(-points.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Dealt by the row's place, so equal ids or equal vectors don't meet in one task.
    place = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    points = points.withColumn("shard", place).withColumn("block", every(blocks))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))

    def search(left, right):
        ids, wanted = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        if len(ids) and len(wanted):
            matrix = lambda table: np.array(table.column("v").to_pylist(), dtype=np.float64)
            own, inverse = np.unique(matrix(left), axis=0, return_inverse=True)
            by_vector = np.lexsort((ids, inverse.ravel()))
            begins = np.searchsorted(inverse.ravel()[by_vector], np.arange(len(own) + 1))
            forest = Forest(own, trees, bits)
            asked_vectors = matrix(right)
            for i in range(0, len(wanted), 512):
                for query, (places, scores) in zip(wanted[i : i + 512], forest.search(asked_vectors[i : i + 512], k + 1, target)):
                    best = places[np.argsort(-scores, kind="stable")]
                    ranked = np.sort(scores)[::-1]
                    # Whole runs of equal scores, until k ids besides the query's own are there.
                    got, last, rows = 0, None, []
                    for p, s in zip(best.tolist(), ranked.tolist()):
                        if got >= k and s != last:
                            break
                        same = ids[by_vector[begins[p] : begins[p + 1]]]
                        same = same[same != query][:k]
                        rows.append((same, s))
                        got, last = got + len(same), s
                    found = np.concatenate([r[0] for r in rows]) if rows else ids[:0]
                    value = np.concatenate([np.full(len(r[0]), r[1]) for r in rows]) if rows else np.zeros(0)
                    keep = np.lexsort((found, -value))[:k]
                    out[0].append(np.full(len(keep), query))
                    out[1].append(found[keep])
                    out[2].append(value[keep])
        column = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"query_id": column(out[0], pa.int64()), "vec_id": column(out[1], pa.int64()), "score": column(out[2], pa.float64())})

    keys = ["shard", "block", "dims"]
    found = points.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, FOUND).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
