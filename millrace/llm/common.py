"""Helpers that the operators share: scratch tables, word hashes, bounded filters, components."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import delete_path, scratch_dir

# Texts are hashed in chunks of about this many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 18
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = _random.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_random.integers(1, 1 << 62)) * 2 + 1
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


class Scratch:
    """Intermediate tables in the shared folder of the cluster."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.count = spark, scratch_dir(spark), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a table and read it back: cuts the lineage and survives lost executors."""
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Delete a kept table that nothing reads any more."""
        delete_path(self.spark, kept.scratch_path)


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` for a function from a record batch to a dict of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns.values()], list(columns))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those for a chunk are kept, those for a longer text are not."""

    def powers(base: int, size: int) -> np.ndarray:
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        return np.cumprod(table, dtype=np.uint64)

    bases = {"up": _BASE, "down": pow(_BASE, -1, 1 << 64)}
    if n > CHUNK_BYTES + 1:
        return tuple(powers(base, n) for base in bases.values())
    for name, base in bases.items():
        if name not in _powers:
            _powers[name] = powers(base, CHUNK_BYTES + 1)
    return _powers["up"], _powers["down"]


class Words(NamedTuple):
    """Words of a chunk of texts: hash, place in bytes and the number of each text's words."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def hash_words(data: np.ndarray, bounds: np.ndarray, longest: int = 0, overlap: int = 0) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 texts that lie one after another, A-Z lower-cased.

    ``bounds`` has the start of each text and the end of the last one. No word spans two texts.
    With ``longest``, longer words are cut to pieces of that many bytes which overlap, each a word of its own.
    """
    data = np.frombuffer(data.tobytes().translate(LOWER), dtype=np.uint8)
    n = len(data)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edges = np.unique(bounds[(bounds > 0) & (bounds < n)])
    first[edges] = solid[edges]
    last[edges - 1] = solid[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if longest:
        step = longest - overlap
        pieces = 1 + np.maximum(0, -(-(ends - starts - longest) // step))
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + within * step
        ends = np.minimum(starts + longest, np.repeat(ends, pieces))
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    counts = np.diff(np.searchsorted(starts, bounds))
    return Words(hashes, starts, ends, counts)


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a text column to chunks: place of the first text, bytes, and the texts' bounds in them. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        to = min(to, n)
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut to pieces of about so many bytes of the text column; a longer text is a piece of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, to - at)
            at = to


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """Place and sorted distinct shingle hashes of each text; with fewer words, the whole sequence is one."""
    for at, data, bounds in text_chunks(texts):
        words = hash_words(data, bounds)
        n = len(words.hashes)
        rolled = np.zeros(max(n - size + 1, 0), dtype=np.uint64)
        for k in range(size):
            rolled += words.hashes[k : k + len(rolled)] * PLACE[k]
        rolled = mix(rolled)
        begin = 0
        for i, count in enumerate(words.counts.tolist()):
            if count >= size:
                yield at + i, np.unique(rolled[begin : begin + count - size + 1])
            elif count:
                own = words.hashes[begin : begin + count]
                yield at + i, mix(np.array([(own * PLACE[8 : 8 + count]).sum(dtype=np.uint64)], dtype=np.uint64))
            else:
                yield at + i, np.zeros(0, dtype=np.uint64)
            begin += count


# Shingles that are held together; a longer document is held alone.
SET_CHUNK = 1 << 16


def set_pieces(texts: pa.Array, size: int):
    """(place of the first text, sets) for runs of texts with about SET_CHUNK shingles."""
    begin, sets, total = 0, [], 0
    for at, shingles in shingle_sets(texts, size):
        if sets and total + len(shingles) > SET_CHUNK:
            yield begin, sets
            begin, sets, total = at, [], 0
        sets.append(shingles)
        total += len(shingles)
    if sets:
        yield begin, sets


CLASS = ["h1", "h2", "n_shingles"]


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    a = [int(mix(s).sum(dtype=np.uint64)) for s in sets]
    b = [int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) for s in sets]
    return np.array(a, dtype=np.uint64).view(np.int64), np.array(b, dtype=np.uint64).view(np.int64)


def parities(shingles: np.ndarray) -> np.ndarray:
    """Sketch of 2 to 4 bits for each shingle, a power of two of 64-bit words; halves XOR to the smaller sketch."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    place = ((shingles >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def apart_sql(u: str, v: str) -> str:
    """SQL for the Hamming distance of two sketches; of two sizes, the larger is folded."""
    fold = "zip_with(slice({0}, 1, shiftright(size({0}), 1)), slice({0}, shiftright(size({0}), 1) + 1, shiftright(size({0}), 1)), (a, b) -> a ^ b)"
    one = lambda x, y: f"IF(size({x}) > size({y}), {fold.format(x)}, {x})"
    return f"aggregate(zip_with({one(u, v)}, {one(v, u)}, (a, b) -> bit_count(a ^ b)), 0, (s, n) -> s + n)"


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


BUCKET_BITS = 18


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(24)) & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)


def bucket_counts(df: DataFrame, hashes_of) -> np.ndarray:
    """Occurrences of all hashes by bucket: a table of 2^18 numbers, whatever the input's size.

    ``hashes_of`` gives the hashes of a record batch. Each task sends a row for each bucket at most.
    """

    def run(batches):
        table = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for hashes in hashes_of(batch):
                table += np.bincount(bucket_of(hashes), minlength=len(table))
        full = np.flatnonzero(table)
        yield record_batch(bucket=pa.array(full.astype(np.int32)), n=pa.array(table[full]))

    table = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for row in df.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        table[row.bucket] = row.n
    return table


class IdFilter:
    """A bit map of ids, of fixed size: it lets every given id pass, and few others while they are few.

    It only saves shuffling; an exact join follows it. With 2^bits bits, at most 2^(bits - 5) rows of
    12 bytes reach the driver, however many ids there are.
    """

    def __init__(self, ids: DataFrame, column: str, bits: int = 23, hashed: bool = False):
        """``hashed``: the ids are hashes already, whose lower bits are the place."""
        self.bits, self.hashed = bits, hashed
        place = self.place(column)
        words = (
            ids.select(place.alias("p"))
            .groupBy(F.shiftright("p", 5).cast("int").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(p & 31 AS INT)))").alias("b"))
            .collect()
        )
        table = np.zeros(1 << (bits - 5), dtype=np.int64)
        for word in words:
            table[word.w] = word.b
        self.table = ids.sparkSession.sparkContext.broadcast(table)

    def place(self, column: str) -> Column:
        """Where an id's bit is; for ``hits``."""
        number = F.coalesce(F.col(column).cast("long"), F.lit(0))
        return F.pmod(number if self.hashed else F.xxhash64(number), F.lit(1 << self.bits))

    @staticmethod
    def hits(table: np.ndarray, places: pa.Array) -> pa.Array:
        place = places.to_numpy()
        return pa.array((table[place >> 5] >> (place & 31)) & 1 == 1)

    def parts(self, df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        """The rows that may have a given id, and those that surely have none."""
        table, hits = self.table, self.hits

        @F.arrow_udf("boolean")
        def hit(places: pa.Array) -> pa.Array:
            return hits(table.value, places)

        place = self.place(column)
        return df.where(hit(place)), df.where(~hit(place))


def free_name(name: str, *frames: DataFrame) -> str:
    """The name, with underscores as long as some frame has it."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_of_each(docs: DataFrame, gone: DataFrame, counted: DataFrame, scratch: Scratch, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose id is in ``gone``; of the ids that ``counted`` has more than once, equal texts stay once.

    Columns as they are. Only rows that may be among either are shuffled.
    """
    name, often = free_name("_id", docs), free_name("_often", docs)
    own = lambda df: df.select(F.col(id_col).alias(name))
    repeated = own(counted.where(F.col(id_col).isNotNull())).groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name)
    marks = own(gone).distinct().withColumn(often, F.lit(False)).unionByName(repeated.withColumn(often, F.lit(True)))
    marks = scratch.keep(marks.groupBy(name).agg(F.min(often).alias(often)))
    maybe, rest = IdFilter(marks, name).parts(docs, id_col)
    maybe = maybe.join(marks, F.col(id_col) == F.col(name), "left")
    single = maybe.where(F.col(often).isNull()).drop(name, often)
    double = maybe.where(F.col(often)).drop(name, often).dropDuplicates([id_col, text_col])
    return rest.unionByName(single).unionByName(double)


GROUP = 1 << 20  # shingles of the members that are held against one set in a task


class Links:
    """Confirmed links between classes; ``texts`` are the rows (doc_id, text), ``classes`` has cid, its digests and ``rep``, a document."""

    def __init__(self, texts: DataFrame, classes: DataFrame, scratch: Scratch, size: int, num: int, den: int):
        self.texts, self.classes, self.scratch, self.size, self.num, self.den = texts, classes, scratch, size, num, den

    def fits(self, a: str, b: str):
        return (F.col(a) * self.den >= F.col(b) * self.num) & (F.col(b) * self.den >= F.col(a) * self.num)

    def sets_of(self, ids: DataFrame) -> DataFrame:
        """(cid, n, shingles) of classes, from the texts of their documents."""
        size = self.size
        wanted = self.scratch.keep(ids.join(self.classes.select("cid", "rep", *CLASS), "cid"))
        # Documents that are surely not wanted are left out before they are hashed, in the same pass.
        maybe = IdFilter(wanted, "rep")
        table, hits = maybe.table, maybe.hits

        def run(batches):
            for batch in batches:
                batch = batch.filter(hits(table.value, batch.column(2)))
                for at, sets in set_pieces(batch.column(1), size):
                    h1, h2 = digests(sets)
                    yield record_batch(
                        rep=batch.column(0).slice(at, len(sets)), h1=pa.array(h1), h2=pa.array(h2), n_shingles=pa.array([len(s) for s in sets], pa.int64()),
                        shingles=list_array([signed(s) for s in sets], pa.int64()),
                    )

        kind = self.texts.schema["doc_id"].dataType.simpleString()
        sets = self.texts.select("doc_id", "text", maybe.place("doc_id")).mapInArrow(run, f"rep {kind}, h1 long, h2 long, n_shingles long, shingles array<long>")
        # Of a repeated id's texts each finds its own class; equal sets of one class are one.
        sets = sets.join(wanted, ["rep", *CLASS]).groupBy("cid").agg(F.first("n_shingles").alias("n"), F.first("shingles").alias("shingles"))
        kept = self.scratch.keep(sets)
        self.scratch.drop(wanted)
        return kept

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among kept pairs (pivot, member), by their full sets; a kept table."""
        ids = pairs.select(F.explode(F.array("pivot", "member")).alias("cid")).distinct()
        sets = self.sets_of(ids)
        sized = pairs.join(sets.select(F.col("cid").alias("member"), "n"), "member")
        groups = sized.groupBy("pivot").agg(F.ceil(F.sum("n") / GROUP).alias("groups"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g")
        left = groups.select(F.col("pivot").alias("p"), every).join(sets.select(F.col("cid").alias("p"), "shingles"), "p")
        right = pairs.join(groups, "pivot").withColumn("g", F.pmod(F.xxhash64("member"), F.col("groups")))
        right = right.select("pivot", "g", "member").join(sets.select(F.col("cid").alias("member"), "shingles"), "member")
        num, den = self.num, self.den

        def test(one, many):
            taken = []
            if len(one) and len(many):
                own = one.column("shingles").combine_chunks().flatten().to_numpy().view(np.uint64)
                theirs = many.column("shingles").combine_chunks()
                ends, flat = theirs.offsets.to_numpy(), theirs.flatten().to_numpy().view(np.uint64)
                hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                inside = np.concatenate([[0], np.cumsum(hit)])
                both = inside[ends[1:] - ends[0]] - inside[ends[:-1] - ends[0]]
                either = len(own) + np.diff(ends) - both
                taken = np.flatnonzero(both * den >= either * num)
            picked = many.select(["pivot", "member"]).take(pa.array(taken, pa.int64()))
            return picked.rename_columns(["u", "v"])

        kept = self.scratch.keep(left.groupBy("p", "g").cogroup(right.groupBy("pivot", "g")).applyInArrow(test, "u long, v long"))
        self.scratch.drop(sets)
        return kept


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges`` (u, v), a kept table: rows (id, component), the component being its smallest id.

    Each round every node hooks to its smallest neighbour, chains are shortened by pointer jumping, and
    the edges are contracted to the roots, so the nodes left are at least halved per round.
    """
    spark = edges.sparkSession
    edges = edges.where("u <> v").select("u", "v")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = scratch.keep(both.groupBy(F.col("u").alias("id")).agg(F.least(F.col("id"), F.min("v")).alias("parent")))
        while True:
            up = parents.select(F.col("id").alias("parent"), F.col("parent").alias("top"))
            parents = scratch.keep(parents.join(up, "parent").select("id", F.col("top").alias("parent"), (F.col("top") < F.col("parent")).alias("moved")))
            if parents.where("moved").isEmpty():
                break
            parents = parents.drop("moved")
        parents = parents.drop("moved")
        if labels is None:
            labels = parents.select("id", F.col("parent").alias("component"))
        else:
            top = parents.select(F.col("id").alias("component"), "parent")
            labels = labels.join(top, "component", "left").select("id", F.coalesce("parent", "component").alias("component"))
        labels = scratch.keep(labels)
        root = parents.select(F.col("id").alias("u"), F.col("parent").alias("ru"))
        moved = edges.join(root, "u").join(root.select(F.col("u").alias("v"), F.col("ru").alias("rv")), "v")
        edges = scratch.keep(moved.where("ru <> rv").select(F.col("ru").alias("u"), F.col("rv").alias("v")).distinct())
    if labels is None:
        return spark.createDataFrame([], "id long, component long")
    return labels
