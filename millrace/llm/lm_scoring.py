"""Language-model scores of documents by a subword lattice over an existing vocabulary.

**Lattice.** A word is a path of pieces of the vocabulary, the first with the word-start mark. All segmentations count:
a forward recursion in log space sums them to the word's marginal probability. The vocabulary's scores are
those of the file; as a byte-pair file scores a piece by its rank, a rank becomes the Zipf weight 1 / (rank + 10), and
the weights are normalised over first and over later pieces. From these scores, ``ROUNDS`` steps of expectation
maximisation over all distinct training words weigh the pieces for the corpus; the scores stay as a prior of
``PRIOR`` pieces. Characters without a piece are spelled by byte pieces. Words of one length pass the recursions side by
side, in numpy; the few of rare lengths pass a plain recursion with equal results.

**Document.** Its tokens are its words (A-Z lower-cased) and one end. ``score`` is the sum of their log10 probabilities: the lattice's
marginal for a word, with ``END`` for the end. Words count as drawn one by one, so it ranks texts by how usual the make of their
words is (junk, odd scripts and broken encodings score low per token); it knows nothing of word order.
``mixed_score`` has the lattice as the base of an absolute-discounted unigram model: P(t) = (max(c - D, 0) + D * V * B(t)) / N, with
the counts of the training documents, V distinct tokens, D from the tokens seen once and twice, and B the lattice. Both sum
to one over all token strings; ``base_score`` gives all unseen words one share and so does not. Counts cover all training
rows, crc32(doc_id as text) mod 7 other than 2, and are a table that grows with the corpus.

**Joins.** Words are counted per task before the shuffle. Words with more than N / ``HEAVY`` occurrences, ``HEAVY`` at most,
are broadcast; of others a document's distinct words meet the table by a shuffled join.

Null texts are empty and have the end only. Repeated rows are scored each. Columns besides id and text play no part.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, Scratch, mix, record_batch, slices

STOP, END, HEAVY = 0.5, 0.002, 1 << 18
PRIOR, ROUNDS = 1000.0, 2
FLUSH = 250_000
CELLS = 1 << 18  # of the arrays in which words of one length pass the recursions
MARK = "▁"


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 7 == 2


class Weights:
    """Piece weights: of first pieces (without the mark), later pieces and bytes, and the chance that a word ends."""

    def __init__(self, first: dict[str, float], later: dict[str, float], spelled: dict[int, float], stop: float):
        self.first, self.later, self.spelled, self.stop = first, later, spelled, stop
        self.key = uuid.uuid4().hex

    @classmethod
    def read(cls, path: str) -> Weights:
        """The scores of the vocabulary's file."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        first, later, spelled = {}, {}, {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            weight = 1 / (10 + max(0.0, -model.get_score(i)))
            if model.is_byte(i):
                spelled[int(piece[3:5], 16)] = weight
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if piece.startswith(MARK):
                    first[piece[1:]] = weight
                else:
                    later[piece] = weight
        first.setdefault("", 1 / 10)
        for b in range(256):
            spelled.setdefault(b, 1e-6)
        return cls(first, later, spelled, STOP)

    def updated(self, counts: dict[str, float], words: float) -> Weights:
        """The mean of the scores, as ``PRIOR`` pieces of each kind, and expected counts of pieces."""
        own, rest = sum(self.first.values()), sum(self.later.values()) + sum(self.spelled.values())
        first = {p: PRIOR * w / own + counts.get(MARK + p, 0.0) for p, w in self.first.items()}
        later = {p: PRIOR * w / rest + counts.get(p, 0.0) for p, w in self.later.items()}
        spelled = {b: PRIOR * w / rest + counts.get(f"{MARK * 2}{b}", 0.0) for b, w in self.spelled.items()}
        more = sum(later.values()) + sum(spelled.values())
        return Weights(first, later, spelled, (words + PRIOR) / (words + more + PRIOR))


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """Pieces by the hash of their characters, with log weights. A bit map answers most lookups of other strings."""

    def __init__(self, weights: dict[str, float]):
        names = [p for p in weights if p]
        keys = np.array([self.key(p) for p in names], dtype=np.uint64)
        order = np.argsort(keys)
        self.names = [names[i] for i in order.tolist()]
        self.keys = keys[order]
        self.weights = np.array([weights[p] for p in self.names])
        self.longest = max(map(len, names), default=0)
        self.map = np.zeros(1 << 20, dtype=bool)
        self.map[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    @staticmethod
    def key(piece: str) -> int:
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in piece:
                value = value * _BASE + np.uint64(ord(c))
            return int(mix(np.array([value + np.uint64(len(piece))]))[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the pieces, -1 for none."""
        out = np.full(keys.shape, -1, dtype=np.int32)
        if len(self.keys):
            maybe = np.nonzero(self.map[(keys >> np.uint64(44)).astype(np.int64)])
            some = keys[maybe]
            at = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == some, at, -1)
        return out


class Lattice:
    """Log probabilities of pieces; marginal probability of words, and the expected pieces of their segmentations."""

    def __init__(self, weights: Weights):
        own = sum(weights.first.values())
        rest = sum(weights.later.values()) + sum(weights.spelled.values())
        go = math.log(1 - weights.stop)
        self.first = {p: math.log(w / own) for p, w in weights.first.items()}
        self.later = {p: math.log(w / rest) + go for p, w in weights.later.items()}
        self.bytes = {b: math.log(w / rest) + go for b, w in weights.spelled.items()}
        self.stop = math.log(weights.stop)
        self.longest = max(map(len, [*self.first, *self.later]), default=0)
        self.first_pieces, self.later_pieces = Pieces(self.first), Pieces(self.later)

    def spelled(self, char: str) -> float:
        return sum(self.bytes[b] for b in char.encode("utf-8", "surrogatepass"))

    def edges(self, word: str) -> list[list[tuple[int, float]]]:
        """For each end, the (begin, weight) of its pieces; begin -1 is a first piece."""
        n = len(word)
        out: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end in range(min(n, self.longest) + 1):
            weight = self.first.get(word[:end])
            if weight is not None:
                out[end].append((-1, weight))
        for begin in range(n):
            for end in range(begin + 1, min(n, begin + self.longest) + 1):
                weight = self.later.get(word[begin:end])
                if weight is not None:
                    out[end].append((begin, weight))
                elif end == begin + 1:
                    out[end].append((begin, self.spelled(word[begin])))  # no piece for this character
        return out

    @staticmethod
    def forward(edges) -> list[float]:
        """Log of the summed probability of all ways to each place."""
        alpha: list[float] = []
        for own in edges:
            terms = [w if b < 0 else alpha[b] + w for b, w in own if b < 0 or alpha[b] > -math.inf]
            if len(terms) < 2:
                alpha.append(terms[0] if terms else -math.inf)
            else:
                top = max(terms)
                alpha.append(top + math.log(sum([math.exp(t - top) for t in terms])))
        return alpha

    def log_probability(self, word: str) -> float:
        """Natural log of the sum over all segmentations, by the plain recursion."""
        return self.forward(self.edges(word))[-1] + self.stop

    def expect(self, word: str, counts: dict[str, float]) -> None:
        """Add the word's expected pieces, by a backward pass over the same lattice."""
        edges = self.edges(word)
        alpha = self.forward(edges)
        share = [0.0] * len(edges)  # of the paths through each place
        share[-1] = 1.0
        for end in range(len(edges) - 1, -1, -1):
            if not share[end]:
                continue
            for begin, weight in edges[end]:
                if begin < 0:
                    counts[MARK + word[:end]] += share[end] * math.exp(weight - alpha[end])
                elif alpha[begin] > -math.inf:
                    part = share[end] * math.exp(alpha[begin] + weight - alpha[end])
                    share[begin] += part
                    if word[begin:end] in self.later:
                        counts[word[begin:end]] += part
                    else:
                        self._spell(word[begin], part, counts)

    @staticmethod
    def _spell(char: str, part: float, counts: dict[str, float]) -> None:
        for b in char.encode("utf-8", "surrogatepass"):
            counts[f"{MARK * 2}{b}"] += part

    def _groups(self, words: list[str]):
        """(places of words of one length, their characters as rows), or a single word of a length that few have."""
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, edges):
            n = int(lengths[group[0]]) if len(group) else 0
            if len(group) < 8 or not n:
                for i in group.tolist():
                    yield i, None
                continue
            step = max(1, CELLS // (n * min(n, self.longest)))
            for at in range(0, len(group), step):
                own = group[at : at + step]
                flat = "".join([words[i] for i in own.tolist()]).encode("utf-32-le", "surrogatepass")
                yield own, np.frombuffer(flat, dtype=np.uint32).reshape(len(own), n)

    def _numbers(self, codes: np.ndarray):
        """Numbers of the first pieces by length, of the later ones by length and begin, and the weights of spelled characters."""
        rows, n = codes.shape
        codes = codes.astype(np.uint64)
        first, later, value = [], [], np.zeros((rows, n + 1), dtype=np.uint64)
        for size in range(1, min(n, self.longest) + 1):
            value = value[:, : n - size + 1] * _BASE + codes[:, size - 1 :]
            keys = mix(value + np.uint64(size))
            first.append(self.first_pieces.find(keys[:, 0]))
            later.append(self.later_pieces.find(keys))
        chars, inverse = np.unique(codes, return_inverse=True)
        spelled = np.array([self.spelled(chr(c)) for c in chars.tolist()])[inverse.reshape(codes.shape)]
        return first, later, spelled

    def _pass(self, codes: np.ndarray):
        """Log weights of the edges into each place (longest last, then the first piece) and the forward sums."""
        rows, n = codes.shape
        first, later, spelled = self._numbers(codes)
        none = self.first.get("", -math.inf)
        weigh = lambda pieces, numbers: np.where(numbers >= 0, pieces.weights[numbers] if len(pieces.weights) else 0.0, -np.inf)
        own = [np.full(rows, none), *[weigh(self.first_pieces, f) for f in first]]
        edges = [weigh(self.later_pieces, x) for x in later]
        if edges:
            edges[0] = np.where(later[0] >= 0, edges[0], spelled)
        else:
            edges, later = [spelled], [np.full(codes.shape, -1, dtype=np.int32)]
        alpha = np.full((n + 1, rows), -np.inf)
        alpha[0] = none
        for end in range(1, n + 1):
            terms = [alpha[end - size] + edges[size - 1][:, end - size] for size in range(1, min(end, len(edges)) + 1)]
            if end < len(own):
                terms.append(own[end])
            stacked = np.stack(terms)
            top = stacked.max(axis=0)
            safe = np.where(np.isfinite(top), top, 0.0)
            with np.errstate(divide="ignore"):
                alpha[end] = safe + np.log(np.exp(stacked - safe).sum(axis=0))
        return first, later, own, edges, alpha

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for own, codes in self._groups(words):
            out[own] = self.log_probability(words[own]) if codes is None else self._pass(codes)[-1][-1] + self.stop
        return out

    def expect_all(self, words: list[str], counts: dict[str, float]) -> None:
        """``expect`` for many words."""
        firsts, laters = np.zeros(len(self.first_pieces.names)), np.zeros(len(self.later_pieces.names))
        for place, codes in self._groups(words):
            if codes is None:
                self.expect(words[place], counts)
                continue
            first, later, own, edges, alpha = self._pass(codes)
            n, rows = codes.shape[1], len(codes)
            share = np.zeros((n + 1, rows))
            share[n] = 1.0
            with np.errstate(invalid="ignore"):
                for end in range(n, -1, -1):
                    live = share[end] > 0
                    if end < len(own):
                        part = np.where(live, share[end] * np.exp(own[end] - alpha[end]), 0.0)
                        if end:
                            hit = (first[end - 1] >= 0) & live
                            firsts += np.bincount(first[end - 1][hit], part[hit], len(firsts))
                        else:
                            counts[MARK] += float(part.sum())
                    for size in range(1, min(end, len(edges)) + 1):
                        begin = end - size
                        part = np.where(live, share[end] * np.exp(alpha[begin] + edges[size - 1][:, begin] - alpha[end]), 0.0)
                        share[begin] += part
                        number = later[size - 1][:, begin]
                        hit = (number >= 0) & live
                        laters += np.bincount(number[hit], part[hit], len(laters))
                        if size == 1:
                            for i in np.flatnonzero((number < 0) & (part > 0)).tolist():
                                self._spell(chr(codes[i, begin]), float(part[i]), counts)
        for found, pieces, mark in ((firsts, self.first_pieces, MARK), (laters, self.later_pieces, "")):
            for i in np.flatnonzero(found).tolist():
                counts[mark + pieces.names[i]] += float(found[i])


_lattices: dict[str, Lattice] = {}


def lattice(weights: Weights) -> Lattice:
    """Built once in each worker."""
    if weights.key not in _lattices:
        _lattices.clear()
        _lattices[weights.key] = Lattice(weights)
    return _lattices[weights.key]


def reweighed(counted: DataFrame, weights: Weights) -> Weights:
    """One step of expectation maximisation over all distinct training words.

    Tasks send a row for each piece of the vocabulary at most, and so does the sum to the driver.
    """
    shared = counted.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        own, counts, words = lattice(shared.value), defaultdict(float), 0
        for batch in batches:
            own.expect_all([word.decode("utf-8", "surrogatepass") for word in batch.column(0).to_pylist()], counts)
            words += batch.num_rows
        counts["\n"] = float(words)
        yield record_batch(piece=pa.array(list(counts), pa.string()), n=pa.array(list(counts.values()), pa.float64()))

    sums = counted.where("c > 0").select("word").mapInArrow(run, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    found = {row.piece: row.n for row in sums.collect()}
    words = found.pop("\n", 0.0)
    return weights.updated(found, words)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def word_counts(df: DataFrame) -> DataFrame:
    """(word, c): occurrences in training rows; words of other rows only come with 0."""

    def run(batches):
        counts: Counter = Counter()

        def rows():
            out = record_batch(word=pa.array(list(counts), pa.binary()), c=pa.array(list(counts.values()), pa.int64()))
            counts.clear()
            return out

        for batch in slices(batches, 1):
            for text, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = words_of(text)
                if held:
                    for word in words:
                        counts.setdefault(word, 0)
                else:
                    counts.update(words)
                if len(counts) > FLUSH:
                    yield rows()
        if counts:
            yield rows()

    return df.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Totals:
    """What the formulas need besides a token's count."""

    def __init__(self, tokens: int, kinds: int, once: int, twice: int):
        self.tokens, self.kinds = tokens, kinds
        self.discount = once / (once + 2 * twice) if once and twice else 0.75

    def base(self, c: float) -> float:
        return math.log10((c + 1) / (self.tokens + self.kinds + 1))

    def model(self, c: float, base_probability_log: float) -> float:
        """log10 of the discounted probability; the base's natural log may lie below what a double can hold."""
        if not self.tokens:
            return base_probability_log / math.log(10)
        rest = base_probability_log + math.log(self.discount * self.kinds / self.tokens)
        if c > self.discount:
            own = math.log((c - self.discount) / self.tokens)
            rest = max(own, rest) + math.log1p(math.exp(-abs(own - rest)))
        return rest / math.log(10)


def score(
    docs: DataFrame,
    vocabulary: str | None = None,
    heavy: int = HEAVY,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score). The vocabulary's path is a parameter."""
    vocabulary = vocabulary or public_tokenizers.path("piece_bpe_32k.model")
    scratch, context = Scratch(docs.sparkSession), docs.sparkSession.sparkContext
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(id_col).alias("held"))
    counted = scratch.keep(word_counts(df))
    ends = df.where("NOT held").count()
    kinds = [F.count_if(F.col("c") > 0).alias("v"), *[F.count_if(F.col("c") == k).alias(f"v{k}") for k in (1, 2)]]
    sums = counted.agg(F.sum("c").alias("n"), *kinds).first()
    totals = Totals((sums.n or 0) + ends, sums.v + (ends > 0), sums.v1, sums.v2)

    weights = Weights.read(vocabulary)
    for _ in range(rounds):
        weights = reweighed(counted, weights)
    pieces = context.broadcast(weights)

    def weigh(batches):
        own = lattice(pieces.value)
        for batch in batches:
            counts = batch.column(1).to_pylist()
            words = [word.decode("utf-8", "surrogatepass") for word in batch.column(0).to_pylist()]
            marginal = own.log_probabilities(words) + math.log(1 - END)
            yield record_batch(
                word=batch.column(0), c=batch.column(1), base=pa.array([totals.base(c) for c in counts], pa.float64()),
                lattice=pa.array(marginal / math.log(10)),
                mixed=pa.array([totals.model(c, p) for c, p in zip(counts, marginal.tolist())], pa.float64()),
            )

    sums_of = ("base", "lattice", "mixed")
    table = scratch.keep(counted.mapInArrow(weigh, "word binary, c long, base double, lattice double, mixed double"))
    # No more than ``heavy`` words can have more than this share of all tokens.
    often = F.col("c") > totals.tokens / heavy
    frequent = table.where(often).toArrow()
    shared = context.broadcast((uuid.uuid4().hex, frequent.column("word").to_pylist(), [frequent.column(c).to_numpy() for c in sums_of]))

    def look_up(batches):
        key, words, values = shared.value
        places = _places(key, words)
        for batch in slices(batches, 1):
            out: dict[str, list] = {k: [] for k in ("n", "known", *sums_of, "words", "times")}
            for text in batch.column(1).to_pylist():
                found = Counter(words_of(text))
                rows, times, rest, rest_times = [], [], [], []
                for word, n in found.items():
                    place = places.get(word)
                    if place is None:
                        rest.append(word)
                        rest_times.append(n)
                    else:
                        rows.append(place)
                        times.append(n)
                n = np.array(times, dtype=float)
                out["n"].append(sum(times) + sum(rest_times))
                out["known"].append(sum(times))
                for name, value in zip(sums_of, values):
                    out[name].append(float(value[rows] @ n) if rows else 0.0)
                out["words"].append(rest)
                out["times"].append(rest_times)
            kinds = (pa.int64(), pa.int64(), *[pa.float64()] * 3, pa.list_(pa.binary()), pa.list_(pa.int32()))
            yield record_batch(
                doc_id=batch.column(0), held=batch.column(2), **{k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds)}
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    doubles = ", ".join(f"{c} double" for c in sums_of)
    schema = f"doc_id {kind}, held boolean, n long, known long, {doubles}, words array<binary>, times array<int>"
    looked = scratch.keep(df.mapInArrow(look_up, schema).withColumn("row", F.monotonically_increasing_id()))
    rest = looked.where("size(words) > 0").select("row", F.inline(F.arrays_zip("words", "times")))
    rare = table.where(~often)
    met = rest.withColumnRenamed("words", "word").join(rare, "word")
    times = F.col("times")
    tails = met.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, times).otherwise(0)).alias("known_t"), *[F.sum(F.col(c) * times).alias(f"{c}_t") for c in sums_of]
    )
    ends_of = {"base": totals.base(ends), "lattice": math.log10(END), "mixed": totals.model(ends, math.log(END))}
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    whole = lambda c: F.col(c) + zero(f"{c}_t") + ends_of[c]
    return looked.join(tails, "row", "left").select(
        F.col("doc_id").alias(id_col),
        F.col("held").alias("held_out"),
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + zero("known_t") + (1 if ends else 0)).cast("long").alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        whole("base").alias("base_score"),
        whole("lattice").alias("score"),
        whole("mixed").alias("mixed_score"),
    )


_maps: dict[str, dict[bytes, int]] = {}


def _places(key: str, words: list[bytes]) -> dict[bytes, int]:
    """Built once in each worker."""
    if key not in _maps:
        _maps.clear()
        _maps[key] = {w: i for i, w in enumerate(words)}
    return _maps[key]
