"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

**Inputs.** A word is given by its own (hashed) vector and by its characters: the mean of the vectors of its
hashed character trigrams. Words of more than ``LONGEST`` bytes, as in texts without white space, are cut to pieces that
overlap by two bytes and are words of their own, so every trigram is read. Both pass one layer to the network's input, once for each distinct word of a batch.
**Network.** Windows of ``WINDOW`` words overlap by half. Each is read forwards and backwards by a gated recurrent
unit; attention pools the states to one logit. A text's score is that of its highest window: every window of
the whole text is scored. A text without words is one empty window of padding.
**Training.** On at most ``SAMPLE`` labelled texts of each class, whose ids hash lowest, by the driver; a text counts
by its highest window (several windows of clean texts). The sample's bound is a parameter; scoring covers all.

Rows whose crc32(doc_id as text) mod 4 is 2 are never learned from, nor are null labels and ids labelled both ways; of a
repeated id one text is. Null texts are empty. Repeated rows are scored each. Only the text is an input of a score.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import PLACE, hash_words, map_batches, mix, record_batch, text_chunks

WINDOW, STEP = 32, 16
LONGEST = 64
SAMPLE = 1000
WORD_BUCKETS, CHAR_BUCKETS, WIDTH, HIDDEN = 1 << 16, 1 << 12, 8, 6
THRESHOLD = 0.3


def held_out(id_col: str = "doc_id"):
    """crc32(doc_id as text) mod 4 is 2."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def sum_rows(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct row numbers and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    return rows[first], np.add.reduceat(values[order], first, axis=0) if len(rows) else values[:0]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def words_of(data: np.ndarray, bounds: np.ndarray):
    return hash_words(data, bounds, LONGEST, 2)


class Vocabulary:
    """Distinct words of some texts: bucket of each, and the buckets of its character trigrams."""

    def __init__(self, data: np.ndarray, words):
        hashes, first, self.inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        self.buckets = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
        starts = words.starts[first]
        lengths = words.ends[first] - starts
        owner = np.repeat(np.arange(len(first)), lengths)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
        lower = lambda b: np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint64)
        last = np.repeat(starts + lengths, lengths)
        code = lower(data[at])
        for k in (1, 2):
            inside = at + k < last
            code = code * np.uint64(257) + np.where(inside, lower(data[np.minimum(at + k, len(data) - 1)]) + np.uint64(1), np.uint64(0))
        self.trigrams = (mix(code * PLACE[0]) >> np.uint64(20)) % np.uint64(CHAR_BUCKETS)
        self.owner, self.lengths = owner, lengths


class Model:
    """Parameters by name; ``forward`` keeps what ``backward`` needs."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        h, w = HIDDEN, WIDTH
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {
            "word": (r.standard_normal((WORD_BUCKETS, w)) * 0.1).astype(np.float32),
            "char": (r.standard_normal((CHAR_BUCKETS, w)) * 0.1).astype(np.float32),
            "pad": np.zeros((1, 2 * w), np.float32),
            "ua": draw(2 * h, h), "a": np.zeros(h, np.float32), "va": draw(h),
            "wo": draw(2 * h), "bo": np.full(1, -2.0, np.float32),
        }
        for d in "fb":
            self.p |= {f"w{d}": draw(2 * w, 3 * h), f"u{d}": draw(h, 3 * h), f"c{d}": np.zeros(3 * h, np.float32)}

    def word_inputs(self, vocabulary: Vocabulary) -> np.ndarray:
        """Input vector of each distinct word; the padding comes last."""
        chars = self.p["char"][vocabulary.trigrams.astype(np.int64)]
        begins = np.cumsum(vocabulary.lengths) - vocabulary.lengths
        mean = np.add.reduceat(chars, begins, axis=0) / vocabulary.lengths[:, None] if len(begins) else np.zeros((0, WIDTH), np.float32)
        own = np.concatenate([self.p["word"][vocabulary.buckets], mean.astype(np.float32)], axis=1)
        return np.concatenate([own, self.p["pad"]])

    def forward(self, projected: dict[str, np.ndarray], windows: np.ndarray, keep: bool = False):
        """Logits of windows (rows of distinct-word places). ``projected``: each word's input to the gates."""
        n, h = len(windows), HIDDEN
        states = np.zeros((WINDOW, n, 2 * h), np.float32)
        kept: dict = {}
        for d, steps in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
            u, s = self.p[f"u{d}"], np.zeros((n, h), np.float32)
            u1, u2 = np.ascontiguousarray(u[:, : 2 * h]), np.ascontiguousarray(u[:, 2 * h :])
            side = slice(0, h) if d == "f" else slice(h, 2 * h)
            x_all = projected[d]
            for t in steps:
                x = x_all[windows[:, t]]
                gates = _sigmoid(x[:, : 2 * h] + s @ u1)
                z, g = gates[:, :h], gates[:, h:]
                c = np.tanh(x[:, 2 * h :] + (g * s) @ u2)
                if keep:
                    kept[d, t] = (s, z, g, c)
                s = s + z * (c - s)
                states[t, :, side] = s
        e = np.tanh(states @ self.p["ua"] + self.p["a"])
        scores = e @ self.p["va"]
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        values = states @ self.p["wo"]
        logits = (weights * values).sum(axis=0) + self.p["bo"][0]
        return (logits, states, kept, e, weights, values) if keep else logits

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {d: inputs @ self.p[f"w{d}"] + self.p[f"c{d}"] for d in "fb"}

    def backward(self, vocabulary: Vocabulary, inputs, windows, kept_all, dlogits) -> dict[str, np.ndarray]:
        _, states, kept, e, weights, values = kept_all
        h, p = HIDDEN, self.p
        g: dict[str, np.ndarray] = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        g["bo"][0] = dlogits.sum()
        dvalues = weights * dlogits
        pooled = (weights * values).sum(axis=0)
        dscores = weights * (values - pooled) * dlogits
        g["wo"] = np.einsum("tn,tnh->h", dvalues, states)
        g["va"] = np.einsum("tn,tnh->h", dscores, e)
        de = dscores[..., None] * p["va"] * (1 - e * e)
        g["ua"] = np.einsum("tnh,tnk->hk", states, de)
        g["a"] = de.sum(axis=(0, 1))
        dstates = dvalues[..., None] * p["wo"] + de @ p["ua"].T
        dinputs = np.zeros_like(inputs)
        for d, steps in (("f", range(WINDOW - 1, -1, -1)), ("b", range(WINDOW))):
            u, side = p[f"u{d}"], (slice(0, h) if d == "f" else slice(h, 2 * h))
            ds = np.zeros((len(windows), h), np.float32)
            dproject = np.zeros((len(inputs), 3 * h), np.float32)
            dgates = np.zeros((WINDOW, len(windows), 3 * h), np.float32)
            for t in steps:
                s, z, r, c = kept[d, t]
                ds = ds + dstates[t, :, side]
                dc = ds * z * (1 - c * c)
                dz = ds * (c - s) * z * (1 - z)
                drs = dc @ u[:, 2 * h :].T
                dr = drs * s * r * (1 - r)
                dgate = np.concatenate([dz, dr, dc], axis=1)
                dgates[t] = dgate
                g[f"u{d}"][:, : 2 * h] += s.T @ dgate[:, : 2 * h]
                g[f"u{d}"][:, 2 * h :] += (r * s).T @ dc
                ds = ds * (1 - z) + drs * r + dgate[:, : 2 * h] @ u[:, : 2 * h].T
            rows, sums = sum_rows(windows.T.ravel(), dgates.reshape(-1, 3 * h))
            dproject[rows] = sums
            g[f"w{d}"] = inputs.T @ dproject
            g[f"c{d}"] = dproject.sum(axis=0)
            dinputs += dproject @ p[f"w{d}"].T
        g["pad"] = dinputs[-1:]
        g["word"] = (vocabulary.buckets, dinputs[:-1, :WIDTH])
        share = dinputs[:-1, WIDTH:] / vocabulary.lengths[:, None]
        g["char"] = (vocabulary.trigrams.astype(np.int64), share[vocabulary.owner])
        return g


def windows_of(counts: np.ndarray, inverse: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over texts that lie one after another, and the text each belongs to."""
    numbers = np.maximum(1, -(-(counts - STEP) // STEP))
    owner = np.repeat(np.arange(len(counts)), numbers)
    begins = np.cumsum(counts) - counts
    within = np.arange(len(owner)) - np.repeat(np.cumsum(numbers) - numbers, numbers)
    at = (within * STEP)[:, None] + np.arange(WINDOW)
    inside = at < counts[owner][:, None]
    flat = np.append(inverse, pad)
    places = np.where(inside, begins[owner][:, None] + at, len(inverse))
    return flat[places], owner


def prepare(texts: list[str | None]):
    """Vocabulary, windows and owners of a chunk of texts."""
    for at, data, bounds in text_chunks(pa.array(texts, pa.string())):
        words = words_of(data, bounds)
        vocabulary = Vocabulary(data, words)
        windows, owner = windows_of(words.counts, vocabulary.inverse, len(vocabulary.buckets))
        yield at, vocabulary, windows, owner


def train(texts: list[str | None], labels: list[int], steps: int = 200, rate: float = 0.02, seed: int = 7) -> Model:
    """Fit on texts by their highest windows, in ``steps`` steps of 64 texts."""
    model, r = Model(seed), np.random.default_rng(seed)
    labels = np.array(labels, dtype=np.float32)
    if not len(labels) or labels.min() == labels.max():
        model.p["bo"][0] = 4.0 if len(labels) and labels[0] else -4.0
        model.p["wo"][:] = 0
        return model
    _start_words(model, texts, labels)
    moments: dict[str, list] = {}
    step = 0
    order = np.concatenate([r.permutation(len(texts)) for _ in range(-(-64 * steps // len(texts)))])
    for begin in range(0, 64 * steps, 64):
        rows = order[begin : begin + 64]
        if len(rows):
            for at, vocabulary, windows, owner in prepare([texts[i] for i in rows]):
                truth = labels[rows[at : at + owner.max() + 1]]
                inputs = model.word_inputs(vocabulary)
                logits = model.forward(model.project(inputs), windows)
                # The highest window of each text, and of a clean one also three drawn at random.
                top = np.lexsort((-logits, owner))
                best = top[np.concatenate([[True], np.diff(owner[top]) != 0])]
                others = np.flatnonzero(truth[owner] == 0)
                others = r.choice(others, min(len(others), 3 * len(truth)), replace=False) if len(others) else others
                chosen = np.unique(np.concatenate([best, others]))
                kept = model.forward(model.project(inputs), windows[chosen], keep=True)
                weight = np.isin(chosen, best) * 1.0 + (~np.isin(chosen, best)) * 0.3
                d = ((_sigmoid(kept[0]) - truth[owner[chosen]]) * weight / len(truth)).astype(np.float32)
                step += 1
                _adam(model, model.backward(vocabulary, inputs, windows[chosen], kept, d), moments, step, rate * (1 - begin / (64 * steps)))
    return model


def _start_words(model: Model, texts, labels) -> None:
    """Word vectors start with the log odds of the word's texts being of class 1."""
    counts = np.zeros((2, WORD_BUCKETS))
    for at, data, bounds in text_chunks(pa.array(texts, pa.string())):
        words = words_of(data, bounds)
        owner = np.repeat(np.arange(len(words.counts)), words.counts)
        pairs = np.unique(owner * WORD_BUCKETS + (words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64))
        kind = labels[at + pairs // WORD_BUCKETS].astype(int)
        np.add.at(counts, (kind, pairs % WORD_BUCKETS), 1)
    share = (counts + 1) / (np.array([[np.sum(labels == 0)], [np.sum(labels == 1)]]) + 2)
    model.p["word"][:, 0] = np.clip(np.log(share[1] / share[0]), -3, 3) * np.minimum(1, counts.sum(axis=0) / 20)


def _adam(model: Model, gradients: dict, moments: dict, step: int, rate: float) -> None:
    for k, g in gradients.items():
        p = model.p[k]
        if isinstance(g, tuple):  # rows of a table: those met only, by their summed gradients
            rows, total = sum_rows(*g)
            square = moments.setdefault(k, [np.zeros(len(p), np.float32)])[0]
            square[rows] += (total * total).mean(axis=1)
            p[rows] -= rate * total / (np.sqrt(square[rows]) + 1e-6)[:, None]
            continue
        m, v = moments.setdefault(k, [np.zeros_like(p), np.zeros_like(p)])
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)


def score_texts(model: Model, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for at, data, bounds in text_chunks(texts):
        words = words_of(data, bounds)
        vocabulary = Vocabulary(data, words)
        projected = model.project(model.word_inputs(vocabulary))
        windows, owner = windows_of(words.counts, vocabulary.inverse, len(vocabulary.buckets))
        logits = np.concatenate([model.forward(projected, windows[i : i + 2048]) for i in range(0, len(windows), 2048)])
        top = np.full(len(words.counts), -np.inf)
        np.maximum.at(top, owner, logits)
        out[at : at + len(top)] = _sigmoid(top)
    return out


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list, list]:
    """At most ``sample`` texts of each class, by the lowest hash of the id: 2 * sample rows reach the driver.

    An id counts once, with the least of its texts; ids that are labelled both ways are not learned from.
    """
    known = labels.where(~held_out()).where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    known = known.select("doc_id", "toxic", F.xxhash64("doc_id").alias("h"))
    chosen = [known.where(F.col("toxic") == k).orderBy("h", "doc_id").limit(sample) for k in (0, 1)]
    ids = chosen[0].unionByName(chosen[1]).drop("h")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = rows.orderBy("doc_id").collect()
    return [row.text for row in rows], [row.toxic for row in rows]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    return train(*training_sample(docs, labels, sample))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model.p)
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batch):
        own = Model.__new__(Model)
        own.p = shared.value
        yield record_batch(doc_id=batch.column(0), score=pa.array(score_texts(own, batch.column(1))))

    return map_batches(df, run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents scored below the threshold, all columns as they are; nothing is shuffled."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model.p), docs.columns.index(text_col)

    def run(batch):
        own = Model.__new__(Model)
        own.p = shared.value
        yield batch.filter(pa.array(score_texts(own, batch.column(place)) < threshold))

    return map_batches(docs, run, docs.schema)


def digest(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The contract's columns."""
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def python_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
