"""Best-fit packing: documents as token sequences of at most ``capacity`` ids, in as few sequences as can be.

A document is its ids and one end id. A longer one is cut: whole pieces of ``capacity`` ids, and the rest
as the first piece. Whole pieces are sequences of their own. The rest is dealt to partitions of bounded size;
each is packed by best-fit decreasing, and dual-feasible functions give a lower bound of its sequences. What
lies in sequences with free space of partitions above their bound, and every partition's least filled sequences
when the partitions together are above the bound of all pieces, is exchanged: dealt anew and packed again,
as long as that takes fewer sequences and at most ``rounds`` times.

A null text is empty: one piece with the end id alone. Repeated rows are packed each on its own.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, record_batch, slices

CAPACITY, END_ID = 1024, 2
# Rows that a task packs at once; it holds about 100 bytes for each.
GROUP_ROWS = 50_000
_CACHE_WORDS = 1 << 16
_OTHER_SPACE = re.compile(r" (?:\s|(?<=\s ))")


def _plain(text: str) -> bool:
    """Whether all characters are ASCII or letters."""
    return text.isascii() or "".join(c for c in set(text) if not c.isascii()).isalpha()


class Encoder:
    """Ids of a text, as little-endian unsigned 32-bit bytes.

    Texts whose spaces are all single and between other characters, and whose other characters are ASCII or letters, are
    encoded by the faster library of the same vocabulary. If other characters are among them, they are cut at the spaces, as
    byte-level BPE never joins across the start of a word, and each " word" is looked up or encoded once per worker, plain
    words by the faster library. All else goes to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = _Cache(self)

    def exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        return self.faster(word) if _plain(word) else self.exact(word)

    def faster(self, text: str) -> bytes:
        return self.plain.encode_to_numpy(text).astype("<u4", copy=False).tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if _OTHER_SPACE.search(text) or any(s in text for s in self.special):
            return self.exact(text)
        if _plain(text):
            return self.faster(text)
        first, *rest = text.split(" ")
        return self.word(first) + b"".join(map(self.cache.__getitem__, rest))


class _Cache(dict):
    """Ids of words met lately: of at most twice ``_CACHE_WORDS`` words, the older half goes at once."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.older = encoder, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encoder.word(" " + word)
        if len(self) >= _CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def forget(self) -> None:
        self.older = {}
        self.clear()


_encoders: dict[tuple, Encoder] = {}


def encoder(tokenizer: str, ranks: str) -> Encoder:
    if (tokenizer, ranks) not in _encoders:
        _encoders[tokenizer, ranks] = Encoder(tokenizer, ranks)
    return _encoders[tokenizer, ranks]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter."""
    first = n % capacity if n > capacity else n
    pieces = [(0, first)] if first else []
    return pieces + [(start, capacity) for start in range(first, n, capacity)]


PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """The pieces of every document with the checksum of their ids. The vocabulary's paths are parameters."""
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = encoder(tokenizer, ranks)
        try:
            for batch in slices(batches, 1):
                yield cut_batch(encode, batch)
        finally:
            encode.cache.forget()  # workers are used again, by other operators too

    def cut_batch(encode, batch):
        row, piece, starts, lengths, sums = [], [], [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            ids = encode(text or "") + end
            for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                row.append(i)
                piece.append(k)
                starts.append(start)
                lengths.append(length)
                sums.append(zlib.crc32(ids[4 * start : 4 * (start + length)]))
        return record_batch(
            doc_id=batch.column(0).take(pa.array(row, pa.int64())),
            piece=pa.array(piece, pa.int32()),
            start=pa.array(starts, pa.int64()),
            length=pa.array(lengths, pa.int64()),
            ids_crc32=pa.array(sums, pa.int64()),
        )

    return df.mapInArrow(run, PIECES.format(id=df.schema["doc_id"].dataType.simpleString()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece and the number of bins; among equal fits the newest bin is taken."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_sizes, used = 0, 0  # a bit for each free size that some bin has
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = open_sizes >> size
        if fitting:
            room = size + ((fitting & -fitting).bit_length() - 1)
            own = free[room].pop()
            if not free[room]:
                open_sizes &= ~(1 << room)
        else:
            room, own = capacity, used
            used += 1
        bins[i], offsets[i] = own, capacity - room
        if room > size:
            free[room - size].append(own)
            open_sizes |= 1 << (room - size)
    return bins, offsets, used


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that ``counts[size]`` pieces need at least, by two families of dual-feasible functions."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    counts = np.asarray(counts, dtype=np.int64)
    best = -(-int((sizes * counts).sum()) // capacity)
    total, number = np.cumsum(sizes * counts), np.cumsum(counts)
    for small in range(1, capacity // 2 + 1):
        # Larger than capacity - small counts whole, smaller than small counts nothing.
        large = int(number[-1] - number[capacity - small])
        middle = int(total[capacity - small] - total[small - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 6):
        parts = (k + 1) * sizes
        scaled = np.where(parts % capacity == 0, k * sizes, parts // capacity * capacity)  # in 1 / (k * capacity)
        best = max(best, -(-int((scaled * counts).sum()) // (k * capacity)))
    return best


PACKED = ", bin long, bins long, bound long, filled long"


def _pack(df: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    """Deal the rows evenly, without regard to their contents, and pack each group."""
    columns = [c for c in df.columns if c in ("doc_id", "piece", "start", "length", "ids_crc32")]
    df = df.select(*columns, F.pmod(F.monotonically_increasing_id(), F.lit(groups)).alias("g"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)

    def pack(key, table):
        lengths = table.column("length").to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        filled = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        first = (number << 58) + (key[0].as_py() << 32)
        for name, values in (
            ("offset", offsets), ("bin", bins + first), ("bins", np.full(len(bins), used)),
            ("bound", np.full(len(bins), bound)), ("filled", filled[bins]),
        ):
            table = table.append_column(name, pa.array(values, pa.int64()))
        return table

    return df.groupBy("g").applyInArrow(pack, schema + ", offset long" + PACKED)


def best_fit_packing(docs: DataFrame, capacity: int = CAPACITY, rounds: int = 3, group_rows: int = GROUP_ROWS, **options) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    scratch = Scratch(docs.sparkSession)
    cuts = scratch.keep(pieces(docs, capacity, **options))
    columns = [*cuts.columns, "offset", "bin"]
    whole = cuts.where(F.col("length") == capacity).select(
        *cuts.columns, F.lit(0).cast("long").alias("offset"), (-1 - F.monotonically_increasing_id()).alias("bin")
    )
    rest = cuts.where(F.col("length") < capacity)
    done, number = [whole], 0
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in rest.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[row["length"]] = row["count"]
    if counts.sum():
        groups = max(1, -(-int(counts.sum()) // group_rows))
        packed = scratch.keep(_pack(rest, groups, number, capacity))
        while True:
            # Certified as a whole: no packing of these pieces has fewer sequences.
            used = packed.agg(F.countDistinct("bin")).first()[0]
            own = np.zeros(capacity + 1, dtype=np.int64)
            for row in packed.groupBy("length").count().collect():
                own[row["length"]] = row["count"]
            if used <= lower_bound(own, capacity) or number == rounds:
                break
            number += 1
            gap = F.col("bins") > F.col("bound")
            loose = ((F.col("filled") < capacity) & gap) | (F.col("filled") < capacity - capacity // 16)
            given, kept = packed.where(loose), packed.where(~loose)
            before = given.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("bin").alias("bins")).first()
            if not before.n:
                break
            again = scratch.keep(_pack(given, max(1, -(-before.n // group_rows)), number, capacity))
            if again.agg(F.countDistinct("bin")).first()[0] >= before.bins:
                break
            done.append(kept.select(columns))
            packed = again
        done.append(packed.select(columns))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(*cuts.columns, F.col("bin").alias("sequence_id"), "offset")
