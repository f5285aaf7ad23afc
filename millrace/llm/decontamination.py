"""Benchmark decontamination: one Aho-Corasick automaton over the windows of the test items, one scan per text.

Texts and items are normalised alike: A-Z lower-cased, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window
is ``window`` consecutive words of an item, or all words of a shorter item. A document word inside any
occurrence of a window is hit; hits are mapped back to character spans of the original text.

The patterns are broadcast, so their size is checked: beyond ``max_pattern_bytes`` the items are dealt to
slices with an automaton each, and the documents pass through them one after another without a shuffle.

Null or empty texts and items have no words and no hits. Items without an id are not reported but their words
are hit. Repeated rows are judged each on its own. Columns besides id and text play no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import record_batch, slices

# Fixed by the definition of a word: A-Z to lower case, other ASCII but digits and a-z to a space.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_automata: dict[tuple, tuple] = {}


def normalise(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def item_windows(text: str | None, window: int) -> list[bytes]:
    words = normalise(text)
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def _slices(benchmark: DataFrame, id_col: str, text_col: str, window: int, max_pattern_bytes: int) -> list:
    """Broadcast lists of (item ids as strings, texts), each of bounded size."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where(
        "text IS NOT NULL"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size * window // max_pattern_bytes))
    context = benchmark.sparkSession.sparkContext
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).collect()
        yield context.broadcast((uuid.uuid4().hex, [(row.id, row.text) for row in own]))


def _automaton(items, window: int) -> tuple[ahocorasick.Automaton, list[str]]:
    """Built once in each Python worker; a window carries its number of words and the places of its items."""
    name, rows = items.value
    key = (name, window)
    if key not in _automata:
        owners: dict[bytes, set[int]] = defaultdict(set)
        ids = sorted({i for i, _ in rows if i is not None})
        place = {i: n for n, i in enumerate(ids)}
        for item, text in rows:
            for words in item_windows(text, window):
                owners[words].update([place[item]] if item is not None else [])
        automaton = ahocorasick.Automaton()
        for words, items_of in owners.items():
            pattern = (b" " + words + b" ").decode("latin-1")
            automaton.add_word(pattern, (len(pattern), words.count(b" ") + 1, tuple(items_of)))
        if owners:
            automaton.make_automaton()
        _automata.clear()
        _automata[key] = (automaton if owners else None, ids)
    return _automata[key]


def scan(text: str | None, automaton, ids: list[str]) -> tuple[int, list[tuple[int, int]], list[str]]:
    """Number of words, hit word ranges (start, end), merged, and the items whose windows occur."""
    words = normalise(text)
    if automaton is None or not words:
        return len(words), [], []
    line = " " + b" ".join(words).decode("latin-1") + " "
    found, items = [], set()
    for end, (length, n, owners) in automaton.iter(line):
        found.append((end - length + 1, n))
        items.update(owners)
    if not found:
        return len(words), [], []
    spaces = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
    ranges: list[tuple[int, int]] = []
    for start, n in zip(np.searchsorted(spaces, [f[0] for f in found]).tolist(), [f[1] for f in found]):
        ranges.append((start, start + n))
    return len(words), merge(ranges), [ids[i] for i in items]


def merge(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def character_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code point spans of the original text."""
    if not ranges:
        return []
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    solid = np.frombuffer(raw.tobytes().translate(_TABLE), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [(int(chars[starts[a]]), int(chars[ends[b - 1]])) for a, b in ranges]


REPORT = "n_words long, hits array<int>, items array<string>, spans array<int>"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    max_pattern_bytes: int = 1 << 26,
) -> DataFrame:
    """A row per document: id, ``n_words``, hit word ranges, sorted item ids, character spans (flat pairs)."""
    parts = list(_slices(benchmark, item_col, item_text_col, window, max_pattern_bytes))
    out = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    kind = out.schema[0].dataType.simpleString()
    for number, items in enumerate(parts):
        last = number == len(parts) - 1

        def run(batches, items=items, first=number == 0, last=last):
            automaton, ids = _automaton(items, window)
            for batch in slices(batches, 1):
                texts = batch.column(1).to_pylist()
                before = [(0, [], [])] * len(texts) if first else list(
                    zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist())
                )
                n_words, hits, found, spans = [], [], [], []
                for text, (_, old, old_items) in zip(texts, before):
                    n, ranges, own = scan(text, automaton, ids)
                    ranges = merge(ranges + list(zip(old[::2], old[1::2])))
                    n_words.append(n)
                    hits.append([x for r in ranges for x in r])
                    found.append(sorted(set(own) | set(old_items)))
                    spans.append([x for s in character_spans(text or "", ranges) for x in s] if last else [])
                columns = {id_col: batch.column(0)} | ({} if last else {"text": batch.column(1)})
                yield record_batch(
                    **columns,
                    n_words=pa.array(n_words, pa.int64()),
                    hits=pa.array(hits, pa.list_(pa.int32())),
                    items=pa.array(found, pa.list_(pa.string())),
                    spans=pa.array(spans, pa.list_(pa.int32())),
                )

        out = out.mapInArrow(run, f"`{id_col}` {kind}, " + ("" if last else "text string, ") + REPORT)
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", max_pattern_bytes: int = 1 << 26
) -> DataFrame:
    """The documents without any hit word, all columns as they are; nothing is shuffled."""
    place = docs.columns.index(text_col)
    for items in _slices(benchmark, "item_id", "text", window, max_pattern_bytes):

        def run(batches, items=items):
            automaton, ids = _automaton(items, window)
            for batch in slices(batches, place):
                clean = [not scan(t, automaton, ids)[1] for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def digest(report: DataFrame) -> DataFrame:
    """The contract's columns from the operator's report."""
    signed = F.transform("hits", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))  # ends less starts
    return report.select(
        "doc_id",
        "n_words",
        F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def brute_force(text: str | None, items: list[tuple], window: int = 10) -> tuple[int, int, list[str]]:
    """The definition, word by word; for tests."""
    words = normalise(text)
    hit, found = [False] * len(words), set()
    for item, item_text in items:
        for pattern in item_windows(item_text, window):
            parts = pattern.split(b" ")
            for i in range(len(words) - len(parts) + 1):
                if words[i : i + len(parts)] == parts:
                    hit[i : i + len(parts)] = [True] * len(parts)
                    found.add(str(item))
    return len(words), sum(hit), sorted(found)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
