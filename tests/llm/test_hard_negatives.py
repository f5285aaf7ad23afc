"""Hard negatives against brute force, and their defined results."""

from __future__ import annotations

import math

import numpy as np
import pytest

from millrace.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, shard int, dims string"


def by_force(rows, anchor=lambda i: i % 100 == 0, k=5):
    """Rows (anchor, positive, rank, negative, scores) of distinct usable rows with distinct ids."""
    x = {i: [math.floor(256 * c) for c in v] for i, v, _ in rows}
    label = {i: lab for i, _, lab in rows}
    dot = lambda a, b: sum(p * q for p, q in zip(x[a], x[b]))
    out = []
    for a in filter(anchor, x):
        others = [(i, dot(a, i)) for i in x if i != a and len(x[i]) == len(x[a])]
        others.sort(key=lambda t: (-t[1], t[0]))
        for positive, p in [t for t in others if label[t[0]] == label[a]][:k]:
            hard = [t for t in others if label[t[0]] != label[a] and 80 * p <= 100 * t[1] <= 100 * p][:k]
            out += [(a, positive, rank, i, p, s) for rank, (i, s) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in rows], SCHEMA).repartition(4)
    got = hard_negatives.mine(frame, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("spread,shard_rows,block_rows", [(1.0, 10**6, 10**6), (0.3, 120, 2), (0.0, 90, 3)])
def test_against_force(spark, spread, shard_rows, block_rows):
    r = np.random.default_rng(int(spread * 10))
    centres = r.standard_normal((6, 20))
    kind = r.integers(0, 6, 500)
    vectors = centres[kind] + spread * r.standard_normal((500, 20))
    rows = [(i, [float(c) for c in v], i % 4) for i, v in enumerate(vectors)]
    odd = [(1000, None, 1), (1100, [], 1), (1200, [float("nan")] * 20, 1), (1300, [None] * 20, 1), (1400, rows[0][1], None), (None, rows[0][1], 1), (1500, [1.0, 2.0], 1)]
    got = mined(spark, rows + odd + rows[:40], shard_rows=shard_rows, block_rows=block_rows)
    assert got == by_force(rows) and got


def test_negative_zero_and_few(spark):
    rows = [(0, [1.0, 0.0], 1), (100, [0.0, 1.0], 2), (1, [0.0, 5.0], 1), (2, [0.0, -3.0], 2), (3, [-1.0, 0.0], 1), (4, [0.5, 0.5], 3)]
    assert mined(spark, rows) == by_force(rows)
    assert mined(spark, []) == [] and mined(spark, rows[:1]) == []


def test_repeated_ids_are_no_partners(spark):
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 0.9], 1), (0, [1.0, 0.8], 2), (7, [1.0, 1.0], 1), (8, [0.9, 0.95], 2)]
    frame = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in rows], SCHEMA)
    got = hard_negatives.mine(frame).collect()
    assert len({r.anchor_no for r in got}) == 2 and all(0 not in (r.positive_id, r.negative_id) for r in got)


@pytest.mark.parametrize("size", [1e9, 1e15])
def test_large_values_stay_exact(spark, size):
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in size * (1 + 1e-9 * r.standard_normal(5))], i % 3) for i in range(0, 60)]
    rows[0] = (0, rows[0][1], 0)
    expected = by_force(rows)
    fits = lambda v: v if v < 1 << 63 else None
    key = lambda row: tuple(-1 if v is None else v for v in row)
    assert sorted(mined_raw(spark, rows), key=key) == sorted(((a, p, k, n, fits(s), fits(t)) for a, p, k, n, s, t in expected), key=key) and expected


def mined_raw(spark, rows):
    frame = spark.createDataFrame([(i, v, lab, 1, 2, "x") for i, v, lab in rows], SCHEMA)
    return [(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in hard_negatives.mine(frame).collect()]


def test_bounds_shrink_the_bitmap():
    """On clustered vectors most rows lose their bit before all dimensions are read."""
    r = np.random.default_rng(0)
    centres = r.standard_normal((40, 64)) * 200
    kind = r.integers(0, 40, 4000)
    matrix = (centres[kind] * np.geomspace(4, 0.05, 64) + r.standard_normal((4000, 64))).astype(np.int64)
    shard = hard_negatives.Shard(np.arange(4000), kind % 5, matrix, int(np.abs(matrix).max()))
    seen = []
    rows, score = shard.scan(matrix[0], shard.ids != 0, lambda rows, least, most: seen.append(len(rows)) or most >= np.sort(least)[-5])
    exact = matrix @ matrix[0]
    exact[0] = np.iinfo(np.int64).min
    assert sorted(score.astype(int).tolist())[-5:] == sorted(exact.tolist())[-5:]
    assert sum(seen) < 0.5 * len(seen) * 4000
