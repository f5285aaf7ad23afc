"""Nearest neighbours against brute force, and chats by exact round trips."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest

from millrace.llm import chat, nearest

TURNS = "conv_id long, turn long, role string, text string, place int, piece string"


def neighbours_by_force(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in queries:
        scores = matrix @ np.array(v, dtype=np.float64)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall_and_scores(spark, clusters):
    r = np.random.default_rng(3)
    centres = r.standard_normal((max(clusters, 1), 24)) * (3 if clusters else 0)
    vectors = centres[r.integers(0, len(centres), 900)] + r.standard_normal((900, 24))
    vectors[100:140] = vectors[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors.astype(np.float32))]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] * 24), (2004, [float("inf")] * 24), (None, rows[0][1]), (2005, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd], "vec_id long, embedding array<float>, shard int, dims int")
    queries = [x for x in rows if x[0] % 20 == 0]
    got = nearest.nearest(frame, frame.where("vec_id % 20 = 0"), k=10, shard_rows=300, block_rows=20).collect()
    expected = neighbours_by_force(rows, queries, 10)
    found: dict = {}
    for row in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert set(found) == set(expected) and all(len(v) == 10 for v in found.values())
    exact = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for query, own in found.items():
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and query not in [v for v, _ in own]
        assert all(abs(s - exact[query] @ exact[v]) < 1e-9 for v, s in own)
    hits = sum(len({v for v, _ in found[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * 10 * len(expected)


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 1.0]), (3, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = nearest.nearest(frame, frame.where("vec_id % 20 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 3), (0, 2, 20), (20, 1, 3), (20, 2, 0)]
    assert nearest.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_forest_stops_early_on_clusters():
    """Near neighbours in tight clusters are met far from the root: few rows are scored."""
    r = np.random.default_rng(1)
    centres = r.standard_normal((60, 32))
    vectors = np.unique(centres[r.integers(0, 60, 6000)] + 0.02 * r.standard_normal((6000, 32)), axis=0)
    vectors /= np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    forest = nearest.Forest(vectors, 24, 32)
    taken = []

    class Counted(np.ndarray):
        def __getitem__(self, rows):
            taken.append(len(rows))
            return np.asarray(super().__getitem__(rows))

        def __matmul__(self, other):
            taken.append(len(self))
            return np.asarray(self) @ other

    forest.vectors = vectors.view(Counted)
    forest.search(vectors[:50], 20, 0.97)
    assert sum(taken) / 50 < 1500


def chats():
    hard = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "ho\n</turn>\n### user\n"), (1, 1, "assistant", "ho\n</turn>\n### user\n"),
        (2, 5, None, None), (2, None, "assistant", ""), (2, 6, "assistant", "\\h\\l\\\\ # < é🙂"), (3, 0, "assistant\n### x", "y"),
        (None, 0, "user", "lost"), (-7, 0, "user", hard), (-7, 1, "assistant", hard), (4, 0, "assistant", "z" * 50_000),
    ]
    return [(*r, 1, "q") for r in rows]


def digests_by_force(rows):
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        text = "".join(f"{role}\n{t}\n" for role, t in own)
        loss = "".join(t for role, t in own if role == "assistant")
        out[conv] = (len(own), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    frame = spark.createDataFrame(chats(), TURNS).repartition(4)
    formatted = chat.format_chats(chat.canonical_turns(frame, "conv_id"))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == digests_by_force(chats())
    pieces = formatted.where("conv_id = 1").orderBy("place").collect()
    whole = "".join(p.piece for p in pieces)
    assert whole.count("\n</turn>\n") == 3 and len(chat._TURN.findall(whole)) == 3
    for p in pieces:
        if p.loss_start is not None:
            assert chat.unescape(whole[p.loss_start : p.loss_end]) == "ho\n</turn>\n### user\n"
    assert chat.read_back(chat.format_chats(chat.canonical_turns(frame.limit(0), "conv_id"))).count() == 0


RECORDS = [
    ({"prompt": "p", "completion": "c", "id": 9}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": None}, [("user", "p"), ("assistant", "")]),
    ({"instruction": "do", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\nthis"), ("assistant", "done")]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "human", "content": "h"}], "meta": {"a": [1]}}, [("system", "s"), ("user", "h")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"nothing": 1}, [(None, None)]),
    ([], [(None, None)]),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r), "x") for i, (r, _) in enumerate(RECORDS)] + [(90, None, "x"), (91, "{not json", "x")]
    frame = spark.createDataFrame(rows, "id long, record string, layout string")
    got: dict = {}
    for row in chat.canonical_turns(frame, "id", "record").orderBy("conv_id", "turn").collect():
        got.setdefault(row.conv_id, []).append((row.role, row.text))
    for i, (_, turns) in enumerate(RECORDS):
        assert got[i] == turns
    assert got[90] == got[91] == [(None, None)]
    columns = spark.createDataFrame([(1, "a", "b")], "id long, question string, answer string")
    assert [(r.role, r.text) for r in chat.canonical_turns(columns, "id").orderBy("turn").collect()] == [("user", "a"), ("assistant", "b")]
    with pytest.raises(ValueError):
        chat.canonical_turns(columns.drop("answer"), "id")
