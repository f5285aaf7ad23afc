"""Secret scan: three fixed patterns, and strings that a battery of randomness tests finds random.

Candidates are runs of 16 and more of ``A-Za-z0-9+/_=-``. For each the encoding is inferred (hex, base 36,
base 62, base 64), and three tests are run against the letters' order in it: chi-squared for a uniform
alphabet, Wald-Wolfowitz runs about the median and serial correlation of neighbours. The three p-values are
combined (Fisher). Short strings of prose pass such tests by chance, and the more so the shorter they are, so
the false discoveries are controlled per length. The null are pieces of running prose: the letters outside of long
runs, put together, cut to the least length of each class and read in each encoding. The share of them that reaches a score
is the p-value of that score, so no words of that length are needed. All letters of all texts are cut into such pieces;
short of ``FLOOR`` pieces in all, common English words in random order stand in.
Benjamini-Hochberg over all candidates of a class sets the p-value up to which they are taken. The counts cover all texts;
they are a table of fixed size.

Null and empty texts have no spans. Repeated rows are judged each on its own, extra columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, record_batch, text_chunks

# Fixed patterns and limits of the contract.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
WORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
KINDS = ("assign", "access", "hex", "random")

LENGTHS = (16, 20, 24, 32, 40, 64, 128)  # least of each class
SHORTEST, BINS, BUCKETS = LENGTHS[0], 64, len(LENGTHS)
FLOOR = 2000
_HEX = np.zeros(256, dtype=bool)
_HEX[[*b"0123456789abcdef"]] = True
_RUN = np.zeros(256, dtype=bool)
_RUN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_ENGLISH = """the of and to in is that for it was with as on be at by this had not are but from or have an they which one you
were all her she there would their we him been has when who will no more if out so up said what its about than into them can
only other time new some could these two may first then do any like my now over such our man me even most made after also did
many off before must well back through years much where your way down should because long each just state those people too
work part great house water place small number always world still government against school country important company
""".split()


def runs(data: np.ndarray, bounds: np.ndarray, members: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of member bytes that are long enough, none across a text's bound."""
    inside = members[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = np.unique(bounds[(bounds > 0) & (bounds < len(data))])
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def bucket(length: int) -> int:
    """Length class: 16-19, 20-23, 24-31, 32-39, 40-63, 64-127, 128 and more."""
    return sum(length >= x for x in LENGTHS[1:])


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters in their order, and a number that is shared by the cases of one encoding.
ENCODINGS = (
    (_DIGITS + _LOWER[:6], 0), (_DIGITS + _UPPER[:6], 0), (_LOWER, 1), (_UPPER, 1), (_DIGITS + _LOWER, 2), (_UPPER + _DIGITS, 3),
    (_UPPER + _LOWER + _DIGITS, 4), (_UPPER + _LOWER + _DIGITS + "+/-_=", 5),
)
NUMBER, KINDS_OF = dict(ENCODINGS), 6


def encoding(token: str) -> str:
    """The letters the token is likely drawn from, in their order."""
    used = set(token)
    return next((letters for letters, _ in ENCODINGS if used <= set(letters)), ENCODINGS[-1][0])


def _tails(z: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(x / math.sqrt(2)) for x in np.abs(z).tolist()])


def _uniform(squares: np.ndarray, n: int, k: int) -> np.ndarray:
    """p-values of chi-squared by the Wilson-Hilferty approximation, from the sums of the squared counts; the upper side only, as too even is no prose."""
    chi = np.maximum(squares * (k / n) - n, 0)
    z = ((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    return np.array([0.5 * math.erfc(v / math.sqrt(2)) for v in z.tolist()])


def _alternation(a: np.ndarray, changes: np.ndarray, n: int) -> np.ndarray:
    """p-values of the runs test, from the letters above the median and the changes of side."""
    b = n - a
    mean = 2 * a * b / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / max(n - 1, 1), 1e-9)
    return np.where((a > 0) & (b > 0), _tails((1 + changes - mean) / np.sqrt(var)), 2.0 ** (1 - n))


def _serial(products: np.ndarray, spread: np.ndarray, n: int) -> np.ndarray:
    """p-values of the correlation of neighbours."""
    flat = spread == 0
    p = _tails((products / np.where(flat, 1, spread) + 1 / n) * math.sqrt(n))
    p[flat] = 0
    return p


def _log(p: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p, 1e-300))


def _fisher(logs: np.ndarray) -> np.ndarray:
    """Upper tail of chi-squared with six degrees of freedom, from the sums of three logarithms."""
    s = -2 * logs
    return np.exp(-s / 2) * (1 + s / 2 + s * s / 8)


def randomness_of(x: np.ndarray, k: int) -> np.ndarray:
    """Fisher's combination of the three p-values of rows of places among ``k`` letters, 0 (surely not random) to 1."""
    rows, n = x.shape
    cells = np.bincount((x + k * np.arange(rows)[:, None]).ravel(), minlength=rows * k).reshape(rows, k)
    high = x > (k - 1) / 2
    changes = (high[:, 1:] != high[:, :-1]).sum(axis=1)
    d = x - x.mean(axis=1)[:, None]
    tests = (
        _uniform((cells * cells).sum(axis=1), n, k), _alternation(high.sum(axis=1), changes, n),
        _serial((d[:, 1:] * d[:, :-1]).sum(axis=1), (d * d).sum(axis=1), n),
    )
    return _fisher(sum(_log(p) for p in tests))


def randomness(token: str) -> float:
    """The same for a token in its encoding."""
    letters = encoding(token)
    place = {c: i for i, c in enumerate(letters)}
    return float(randomness_of(np.array([[place[c] for c in token]]), len(letters))[0])


def binned(p):
    return np.minimum(BINS - 1, (p * BINS)).astype(np.int64)


def _readings() -> list[tuple[np.ndarray, int, list[tuple[int, int, int]]]]:
    """The ways to read prose: places of its letters from 0, their count, and (number, first place, letters) of the encodings that read so.

    Encodings that differ in where the letters begin only share the counts of letters and the correlation of neighbours.
    """
    out: dict[bytes, tuple] = {}
    for number in range(KINDS_OF):
        # Hex has few of the letters of prose, so hex is held against prose in base 36.
        letters = next(x for x, n in ENCODINGS if n == (number or 2))
        place = np.zeros(256, dtype=np.uint8)
        for c in _LOWER + _UPPER:
            place[ord(c)] = next(letters.index(own) for own in (c, c.upper(), c.lower()) if own in letters)
        first = int(place[_LETTER].min())
        place[_LETTER] -= first
        out.setdefault(place.tobytes(), (place, int(place.max()) + 1, []))[2].append((number, first, len(letters)))
    return list(out.values())


READINGS = _readings()


@cache
def _uniform_logs(n: int, k: int) -> np.ndarray:
    """Logarithms by the sum of the squared counts."""
    return _log(_uniform(np.arange(n * n + 1), n, k))


@cache
def _alternation_logs(n: int) -> np.ndarray:
    """Logarithms by letters above the median, then changes of side."""
    a, changes = np.divmod(np.arange((n + 1) * n), n)
    return _log(_alternation(a, changes, n))


def pieces(read: np.ndarray, bounds: np.ndarray, length: int) -> np.ndarray:
    """All texts cut into pieces, a column each: one after the other, and where letters are left, the last of the text once more."""
    parts = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - begin >= length:
            whole = begin + (end - begin) // length * length
            parts.append(read[begin:whole])
            if whole < end:
                parts.append(read[end - length : end])
    return np.ascontiguousarray(np.concatenate([read[:0], *parts]).reshape(-1, length).T)


def prose_counts(letters: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Scores of all pieces of texts' letters by encoding and class: every letter of a text that is long enough is in a piece."""
    counts = np.zeros((KINDS_OF, BUCKETS, BINS), dtype=np.int64)
    for place, distinct, encodings in READINGS:
        read = place[letters]
        for size, length in enumerate(LENGTHS):
            x = pieces(read, bounds, length)
            rows = x.shape[1]
            if not rows:
                continue
            wide = x.astype(np.int32)
            cells = np.bincount((wide + distinct * np.arange(rows, dtype=np.int32)).ravel(), minlength=rows * distinct).reshape(rows, distinct)
            squares = np.einsum("ij,ij->i", cells, cells)
            total = wide.sum(axis=0, dtype=np.int64)
            spread = np.einsum("ij,ij->j", wide, wide) - total * total / length
            ends = total / length * (2 * total - wide[0] - wide[-1])
            products = np.einsum("ij,ij->j", wide[1:], wide[:-1]) - ends + (length - 1) * (total / length) ** 2
            serial = _log(_serial(products, np.where(spread < 1e-6, 0, spread), length))
            for number, first, k in encodings:
                high = (x > (k - 1) / 2 - first).view(np.uint8)
                a = high.sum(axis=0, dtype=np.uint8).astype(np.int64)
                changes = (high[1:] ^ high[:-1]).sum(axis=0, dtype=np.uint8)
                logs = serial + _uniform_logs(length, k)[squares] + _alternation_logs(length)[a * length + changes]
                counts[number, size] += np.bincount(binned(_fisher(logs)), minlength=BINS)
    return counts


def prose_letters(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The letters of each text outside of the given runs, and the texts' bounds in them."""
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[starts] += 1
    step[ends] -= 1
    inside = _LETTER[data] & (np.cumsum(step[:-1], dtype=np.int8) == 0)
    return data[inside], np.concatenate([[0], np.cumsum(inside)])[bounds]


def english_counts() -> np.ndarray:
    """Scores of ``FLOOR`` pieces each of common words in random order."""
    r = random.Random(7)
    texts = ["".join(r.choices(_ENGLISH, k=300)) for _ in range(FLOOR)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return prose_counts(np.frombuffer("".join(texts).encode(), dtype=np.uint8), bounds)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of assign and access; hex comes from the byte runs."""
    found = []
    lower = text.lower()
    if any(w.decode() in lower for w in WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found


SCAN = "doc_id {id}, spans array<string>, starts array<int>, ends array<int>, kinds array<int>, "\
       "scores array<int>, cells array<int>, counts array<long>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass: a row per document with its spans and scored candidates, and a row per batch with the counts.

    ``counts`` has, for pieces of prose and for candidates, the number by encoding, length class and score; it is
    null for documents.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches):
        cache: dict[str, tuple[int, int]] = {}

        def judged(token: str) -> tuple[int, int]:
            """Encoding and score."""
            found = cache.get(token)
            if found is None:
                if len(cache) > 200_000:
                    cache.clear()
                found = cache[token] = NUMBER[encoding(token)], int(binned(np.array(randomness(token))))
            return found

        for batch in batches:
            texts = batch.column(1)
            rows: list[list] = [[] for _ in range(len(texts))]
            counts = np.zeros((2, KINDS_OF, BUCKETS, BINS), dtype=np.int64)
            for at, data, bounds in text_chunks(texts):
                raw = data.tobytes()
                chars = None
                for members, least, name in ((_HEX, 24, 2), (_RUN, SHORTEST, 3)):
                    starts, ends = runs(data, bounds, members, least)
                    owner = np.searchsorted(bounds, starts, side="right") - 1
                    if len(starts) and chars is None:
                        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    for s, e, o in zip(starts.tolist(), ends.tolist(), owner.tolist()):
                        score = cell = 0
                        if name == 3:
                            token = raw[s:e].decode("ascii")
                            number, score = judged(token)
                            size = bucket(e - s)
                            cell = number * BUCKETS + size
                            counts[1, number, size, score] += 1
                        first = chars[bounds[o]]
                        rows[at + o].append((name, int(chars[s] - first), int(chars[e] - first), score, cell))
                counts[0] += prose_counts(*prose_letters(data, bounds, starts, ends))
            for i, text in enumerate(texts.to_pylist()):
                if text:
                    rows[i] += [(KINDS.index(k), s, e, 0, 0) for k, s, e in base_spans(text)]
                rows[i].sort(key=lambda r: (r[1], r[0]))
            n = len(rows) + 1
            column = lambda j: pa.array([[r[j] for r in own] for own in rows] + [None], pa.list_(pa.int32()))
            yield record_batch(
                doc_id=pa.concat_arrays([batch.column(0), pa.nulls(1, batch.column(0).type)]),
                spans=pa.nulls(n, pa.list_(pa.string())),
                starts=column(1), ends=column(2), kinds=column(0), scores=column(3), cells=column(4),
                counts=pa.array([None] * (n - 1) + [counts.ravel().tolist()], pa.list_(pa.int64())),
            )

    return df.mapInArrow(run, SCAN.format(id=kind))


def thresholds(counts: np.ndarray, rate: float) -> np.ndarray:
    """Lowest score to take for each encoding and length class, by Benjamini-Hochberg over a class; BINS where none is taken."""
    out = np.full((KINDS_OF, BUCKETS), BINS)
    prose, candidates = counts[0].astype(float), counts[1].astype(float)
    short = prose.sum(axis=2) < FLOOR
    if (short & (candidates.sum(axis=2) > 0)).any():
        missing = np.maximum(0, 1 - prose.sum(axis=2) / FLOOR)[..., None]
        stand_in = english_counts()
        prose += stand_in * missing
    above = (prose[..., ::-1].cumsum(axis=2)[..., ::-1] + 1) / (prose.sum(axis=2)[..., None] + 1)
    for size in range(BUCKETS):
        p, n = above[:, size].ravel(), candidates[:, size].ravel()
        order = np.argsort(p, kind="stable")
        taken = n[order].cumsum()
        # Of equal p-values the last counts them all.
        taken = taken[np.searchsorted(p[order], p[order], side="right") - 1]
        good = np.flatnonzero((taken > 0) & (p[order] * n.sum() <= rate * taken))
        if len(good):
            least = above[:, size] <= p[order][good[-1]]
            out[:, size] = np.where(least.any(axis=1), least.argmax(axis=1), BINS)
    return out


def find_secrets(
    docs: DataFrame, rate: float = 0.05, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """A row per document: id and ``spans`` of (kind, start, end, base), by start, then kind as listed."""
    kept = Scratch(docs.sparkSession).keep(scan(docs, id_col, text_col))
    flat = kept.where("counts IS NOT NULL").select(F.posexplode("counts").alias("i", "n"))
    table = np.zeros(2 * KINDS_OF * BUCKETS * BINS, dtype=np.int64)
    for row in flat.groupBy("i").agg(F.sum("n").alias("n")).collect():  # 5,376 rows at most
        table[row.i] = row.n
    least = thresholds(table.reshape(2, KINDS_OF, BUCKETS, BINS), rate).ravel()
    limits = F.array(*[F.lit(int(x)) for x in least])
    zipped = F.arrays_zip("kinds", "starts", "ends", "scores", "cells")
    base = F.filter(zipped, lambda x: x.kinds < 3)
    added = F.filter(
        zipped,
        lambda x: (x.kinds == 3)
        & (x.scores >= F.element_at(limits, x.cells + 1))
        & ~F.exists(base, lambda b: (b.starts < x.ends) & (b.ends > x.starts)),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(
        F.transform(F.concat(base, added), lambda x: F.struct(x.starts.alias("start"), x.kinds.alias("k"), x.ends.alias("end")))
    )
    spans = F.transform(
        ordered,
        lambda x: F.struct(F.element_at(names, x.k + 1).alias("kind"), x.start.alias("start"), x.end.alias("end"), (x.k < 3).alias("base")),
    )
    return kept.where("counts IS NULL").select(F.col("doc_id").alias(id_col), spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(joined(F.filter("spans", lambda s: s.base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def brute_force(text: str | None) -> tuple[int, int, int, str]:
    """The base spans straight from the patterns; for tests."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans.sort()
    line = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(line.encode()).hexdigest()
