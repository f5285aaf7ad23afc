"""SuperMinHash near-duplicates against brute force, with odd rows and hot groups."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_text_operators import SCHEMA, corpus, shingles

from millrace.llm import common, superminhash


def groups_by_force(rows, num=85):
    """Components of the distinct sets by smallest id, by id and set."""
    sets: dict = {}
    for i, t, *_ in rows:
        own = frozenset(shingles(t))
        if i is not None and own:
            sets[own] = min(i, sets.get(own, i))
    keys, parent = list(sets), {s: s for s in sets}

    def root(x):
        while parent[x] is not x:
            x = parent[x]
        return x

    for a in range(len(keys)):
        for b in range(a):
            if 100 * len(keys[a] & keys[b]) >= num * len(keys[a] | keys[b]):
                parent[root(keys[a])] = root(keys[b])
    least: dict = {}
    for s, i in sets.items():
        least[root(s)] = min(i, least.get(root(s), i))
    return {s: least[root(s)] for s in sets}


def check(got, rows):
    groups = groups_by_force(rows)
    expected = []
    for i, t, *_ in rows:
        own = frozenset(shingles(t))
        group = None if i is None else groups.get(own, i)
        expected.append((i, len(own), group, None if i is None else i == group))
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*row, *[None] * (10 - len(row))) for row in rows], SCHEMA).repartition(parts)


def test_against_force(spark):
    rows = corpus()
    rows += [(500, rows[20][1]), (500, rows[30][1]), (None, rows[21][1]), (7, rows[25][1])]
    check(superminhash.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id", "kept").collect(), rows)


def test_hot_group_of_near_copies(spark, monkeypatch):
    """A chain of drifting copies, many copies around one text, and unlinked texts that share a band now and then."""
    monkeypatch.setattr(common, "GROUP", 2000)
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]
    rows, drift = [], list(base)
    for i in range(120):
        own = list(base)
        for _ in range(r.randint(0, 3)):
            own[r.randrange(len(own))] = word()
        rows.append((1000 + i, " ".join(own)))
        drift[r.randrange(len(drift))] = word()
        rows.append((3000 - i, " ".join(drift)))
        far = list(base)
        for _ in range(r.randint(4, 7)):
            far[r.randrange(len(far))] = word()
        rows.append((5000 + i, " ".join(far)))
    rows += rows[:200]
    check(superminhash.near_duplicates(frame(spark, rows, 5)).collect(), rows)


@pytest.mark.parametrize("size", [1, 2, 7, 60, 900, 5000])
def test_signatures_by_force(size):
    """Level by level against the plain algorithm: each element's own permutation, all levels, least value per slot."""
    r = np.random.default_rng(size)
    slots, sets = 125, [np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(3)]
    m64 = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & m64
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & m64
        return x ^ (x >> 31)

    got = superminhash.superminhash(sets, slots)
    for own, signature in zip(sets, got):
        least = [m64] * slots
        for element in own.tolist()[:400] if size > 1000 else own.tolist():
            state, places = mix(element ^ 0x2545F4914F6CDD1D), list(range(slots))
            for level in range(slots):
                state = mix((state + 0x9E3779B97F4A7C15) & m64)
                step = level + (((state >> 32) * (slots - level)) >> 32)
                places[level], places[step] = places[step], places[level]
                value = (level << 56) | (mix(state ^ 0xD6E8FEB86659FD93) >> 8)
                least[places[level]] = min(least[places[level]], value)
        if size > 1000:
            assert all(int(s) <= v for s, v in zip(signature, least)) and int(signature.max()) >> 56 == 0
        else:
            assert least == signature.tolist()


def test_estimates_have_lower_variance():
    """Share of equal slots against the similarity; the variance is below that of independent slots for small sets."""
    r = np.random.default_rng(1)
    slots, errors = 125, []
    for _ in range(300):
        pool = np.unique(r.integers(0, 1 << 63, 40, dtype=np.uint64))
        a, b = pool[:36], pool[4:]
        x, y = superminhash.superminhash([np.sort(a), np.sort(b)], slots)
        errors.append((x == y).mean() - 32 / len(pool))
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.8 * (0.8 * 0.2 / slots)


def test_planes_bound():
    r = np.random.default_rng(2)
    x = r.integers(0, 1 << 63, (1, 125), dtype=np.uint64)
    y = x.copy()
    y[0, :20] += np.uint64(1)
    a, b = superminhash.planes(np.concatenate([x, y]))
    apart = sum(bin(int((a[i] ^ b[i]) | (a[2 + i] ^ b[2 + i])) & (1 << 64) - 1).count("1") for i in range(2))
    assert 5 <= apart <= 20 < superminhash.most_apart(125, 85, 100)


def test_drop_keeps_one_of_each(spark):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(2, text), (1, text), (1, text), (1, "another text of several words here"), (3, None), (3, None), (None, text), (9, "x y")]
    kept = superminhash.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=key) == sorted([rows[i] for i in (1, 3, 4, 5, 6, 7)], key=key)


def test_empty_table(spark):
    none = frame(spark, [])
    assert superminhash.near_duplicates(none).count() == 0 and superminhash.drop_near_duplicates(none).count() == 0
    odd = [(1, None), (2, ""), (3, " \n")]
    assert sorted(map(tuple, superminhash.near_duplicates(frame(spark, odd)).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
