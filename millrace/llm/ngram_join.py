"""N-gram Jaccard join by parity sketches, exact for the links it is asked for.

**Sketch.** A document's shingles are 64-bit hashes. A sketch has ``blocks`` blocks of 2^64 bits; a shingle
toggles one bit (block ``hash mod blocks``, place ``hash``), so bits are parities. Each element of the symmetric
difference of two sets changes one bit: the Hamming distance, and so the number of blocks that differ, is at most
the size of the symmetric difference. A block is kept as the XOR of the mixed places of its set bits.

**Pigeonhole per size band.** Two sets of sizes a <= b with Jaccard similarity of at least ``num/den`` have
b <= a * den/num, and differ in at most (a + b) * (den - num) / (den + num) elements. A band of sizes is laid out
with more blocks than that, plus a slack for empty blocks: linked sets then share a block that is equal and,
unless both have more empty blocks than the slack, not empty. So a linked pair meets under a key (band, block,
block's value of set bits). The few sets beyond the slack, mostly tiny ones, also have the shingles of their
prefix as keys: of two such sets that are linked, the prefixes meet.

**Frequent shingles.** A block with a single shingle that thousands of documents hold is a poor key. Occurrences are
counted over all documents in a table of fixed size, and shingles of far too full buckets are left out of the
blocks. That keeps the bound, as the difference of the smaller sets is no larger; a prefix takes them last.

**Verify.** Sets that are equal are one class first, so copies never meet under a key. Under a key, members are held
against one pivot, the member that shares most keys with others. A pair whose small parity sketches (2 to 4 bits
for each shingle) are too far apart is no link; of the others the exact similarity is computed. Found
links are contracted to components. Keys whose members are all in one component are done; under others, pivots
are drawn by hash, 8, 64, ... of a key's members until all are, and held against members of other components. Nothing is
capped; pairs within a component already known are never formed.

Defined results: null and empty texts have no shingles and are linked with nothing. Repeated rows (also with equal
ids) give a row each; rows of one id with different texts are told apart by their sets. A null id gives a null component. Columns besides id and text play no part.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    CLASS, Links, Scratch, apart_sql, bucket_counts, bucket_of, components, digests, list_array, mix, one_of_each, parities, record_batch, set_pieces, shingle_sets, signed,
)

NUM, DEN = 80, 100
GROWTH = 8  # of the number of pivots per key, round by round


@lru_cache(maxsize=8)
def bands(num: int = NUM, den: int = DEN, largest: int = 1 << 34) -> list[tuple[int, int, int, int]]:
    """(smallest size, largest size, blocks, slack) of each band.

    A pair belongs to the band of its smaller set. The slack is what a band's smallest set has in empty blocks, and
    two standard deviations.
    """
    out, low = [], 1
    while low < largest:
        following = max(low + 1, low * 3 // 2)
        most = following - 1  # largest smaller set of the band's pairs
        high = most * den // num
        differ = (most + high) * (den - num) // (den + num)
        slack, beyond = 0, differ + 1
        while slack < beyond:
            middle = (slack + beyond) // 2
            blocks = differ + 1 + middle
            empty = blocks * (1 - 1 / blocks) ** low
            slack, beyond = (slack, middle) if middle >= empty + 2 * empty**0.5 else (middle + 1, beyond)
        out.append((low, high, differ + 1 + slack, slack))
        low = following
    return out


def band_keys(shingles: np.ndarray, band: int, blocks: int, slack: int) -> tuple[np.ndarray, bool]:
    """The keys of a set in a band, and whether it has more empty blocks than the slack."""
    if not len(shingles):
        return shingles, blocks > slack
    block = (shingles >> np.uint64(20)) % np.uint64(blocks)
    order = np.argsort(block, kind="stable")
    block, places = block[order], mix(shingles[order] ^ np.uint64(0x9E3779B97F4A7C15))
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    values = np.bitwise_xor.reduceat(places, first)
    full = block[first]
    return mix(values ^ mix(full + np.uint64(band << 40))), blocks - len(full) > slack


def set_keys(shingles: np.ndarray, num: int = NUM, den: int = DEN, frequent: np.ndarray | None = None) -> np.ndarray:
    often = frequent[bucket_of(shingles)] if frequent is not None else np.zeros(len(shingles), dtype=bool)
    rare = shingles[~often]
    n, keys, sparse = len(shingles), [], False
    for i, (low, high, blocks, slack) in enumerate(bands(num, den)):
        if low <= n <= high:
            own, beyond = band_keys(rare, i, blocks, slack)
            keys.append(own)
            sparse |= beyond
    if sparse:
        prefix = n - -(-n * num // den) + 1
        keys.append(mix(np.concatenate([rare, shingles[often]])[:prefix] ^ np.uint64(0xD1B54A32D192ED03)))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


SKETCH = "doc_id {id}, n_shingles long, h1 long, h2 long, bits array<long>, keys array<long>"


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int, num: int, den: int) -> DataFrame:
    """Size, two digests of the set, its small sketch and its keys; a class met before in the same batch leaves its keys out."""
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = bucket_counts(df.select("text"), lambda batch: (s for _, s in shingle_sets(batch.column(0), size)))
    frequent = df.sparkSession.sparkContext.broadcast(counts > 2 * counts.mean() + 1000)

    def run(batches):
        for batch in batches:
            seen = set()
            for at, sets in set_pieces(batch.column(1), size):
                h1, h2 = digests(sets)
                keys = []
                for own, shingles in zip(zip(h1.tolist(), h2.tolist()), sets):
                    keys.append(set_keys(shingles, num, den, frequent.value) if own not in seen else np.zeros(0, np.uint64))
                    seen.add(own)
                yield record_batch(
                    doc_id=batch.column(0).slice(at, len(sets)), n_shingles=pa.array([len(s) for s in sets], pa.int64()),
                    h1=pa.array(h1), h2=pa.array(h2),
                    bits=list_array([parities(s) for s in sets], pa.int64()), keys=list_array([signed(k) for k in keys], pa.int64()),
                )

    return df.mapInArrow(run, SKETCH.format(id=df.schema["doc_id"].dataType.simpleString()))


def shared_keys(keys: DataFrame) -> DataFrame:
    """The (key, h1) whose key has two classes at least; rows stream through sorted partitions."""

    def run(batches):
        last, open_run = None, False  # the row held back, and whether it is in a run of two already
        for batch in batches:
            key, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if last is not None:
                key, own = np.concatenate([[last[0]], key]), np.concatenate([[last[1]], own])
            if not len(key):
                continue
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
            key, own = key[new], own[new]
            same = key[1:] == key[:-1]
            before, after = np.concatenate([[open_run], same]), np.concatenate([same, [False]])
            taken = before | after
            last, open_run = (key[-1], own[-1]), bool(before[-1])
            yield record_batch(key=pa.array(key[:-1][taken[:-1]]), h1=pa.array(own[:-1][taken[:-1]]))
        if last is not None and open_run:
            yield record_batch(key=pa.array([last[0]], pa.int64()), h1=pa.array([last[1]], pa.int64()))

    return keys.repartition("key").sortWithinPartitions("key", "h1").mapInArrow(run, "key long, h1 long")


def ngram_components(
    docs: DataFrame,
    size: int = 5,
    num: int = NUM,
    den: int = DEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): sets are linked when den * |A & B| >= num * |A | B|."""
    scratch = Scratch(docs.sparkSession)
    sketched = scratch.keep(sketches(docs, id_col, text_col, size, num, den))
    rows = scratch.keep(sketched.select("doc_id", "n_shingles", "h1", "h2"))
    owners = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Equal sets are a class; rows of one id with different texts are in different ones.
    classes = owners.groupBy(*CLASS).agg(F.max("bits").alias("bits"), F.min("doc_id").alias("rep"))
    classes = scratch.keep(classes.withColumn("cid", F.monotonically_increasing_id()))
    shared = scratch.keep(shared_keys(sketched.where("size(keys) > 0").select(F.explode("keys").alias("key"), "h1")))
    scratch.drop(sketched)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    linked = class_links(Links(texts, classes, scratch, size, num, den), shared)
    groups = classes.join(linked.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = groups.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = groups.join(least, "component").select(*CLASS, "component_id")
    found = rows.join(named, CLASS, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    found = scratch.keep(found.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id")))
    for kept in (rows, classes, shared):
        scratch.drop(kept)
    return found


def class_links(links: Links, shared: DataFrame) -> DataFrame:
    """Components (id, component) of the classes."""
    scratch, classes, num, den = links.scratch, links.classes, links.num, links.den
    # Two classes with one h1 only make more candidates; the sets decide.
    members = scratch.keep(shared.join(classes.select("h1", "cid", F.col("n_shingles").alias("size")), "h1").select("key", "cid", "size").distinct())
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = scratch.keep(members.join(sizes, "key"))
    weighted = members.join(members.groupBy("cid").agg(F.sum("n").alias("weight")), "cid")
    bits_of = classes.select("cid", F.col("n_shingles").alias("size"), "bits")

    def near(pairs: DataFrame) -> DataFrame:
        """The pairs (pivot, member) whose sketches are near enough."""
        left, right = (bits_of.toDF(name, f"size_{k}", f"bits_{k}") for name, k in (("pivot", "u"), ("member", "v")))
        found = pairs.join(left, "pivot").join(right, "member")
        most = (F.col("size_u") + F.col("size_v")) * (den - num)
        return found.where(F.expr(apart_sql("bits_u", "bits_v")) * (den + num) <= most).select("pivot", "member")

    def canonical(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("pivot", "member").alias("pivot"), F.greatest("pivot", "member").alias("member")).distinct()

    pivots = weighted.groupBy("key").agg(F.max(F.struct("weight", "cid", "size")).alias("p"))
    pivots = pivots.select("key", F.col("p.cid").alias("pivot"), F.col("p.size").alias("a"))
    star = members.select("key", F.col("cid").alias("member"), F.col("size").alias("b")).join(pivots, "key")
    star = scratch.keep(star.where("member <> pivot").where(links.fits("a", "b")).select("pivot", "member").distinct())
    tested = scratch.keep(canonical(star))
    found = links.confirmed(scratch.keep(near(star)))
    linked = components(found, scratch)
    open_members, share = members, 1
    while True:
        labelled = open_members.join(linked.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        # In other keys all members have been pivots, or both have met.
        open_members = scratch.keep(labelled.join(mixed, "key").where(F.col("n") > max(share, 2)))
        if open_members.isEmpty():
            return linked
        # Drawn by hash: about ``share`` of a key's members, all of them in the last round.
        share *= GROWTH
        held = open_members.join(bits_of.select("cid", "bits"), "cid")
        lot = F.pmod(F.xxhash64("key", "cid"), F.lit(1 << 30)) * F.col("n")
        pivots = held.where(lot < F.lit((1 << 30) * share)).select(
            "key", F.col("cid").alias("pivot"), F.col("size").alias("a"), F.col("component").alias("c"), F.col("bits").alias("bits_p")
        )
        held = held.withColumnsRenamed({"cid": "member", "size": "b"}).join(pivots, "key")
        far = F.expr(apart_sql("bits", "bits_p")) * (den + num) > (F.col("a") + F.col("b")) * (den - num)
        pairs = canonical(held.where((F.col("component") != F.col("c")) & links.fits("a", "b") & ~far))
        pairs = scratch.keep(pairs.join(tested, ["pivot", "member"], "left_anti"))
        open_members = open_members.drop("component")
        if not pairs.isEmpty():
            new = links.confirmed(pairs)
            tested = scratch.keep(tested.unionByName(pairs))
            if not new.isEmpty():
                found = scratch.keep(found.unionByName(new))
                linked = components(found, scratch)


def drop_near_copies(docs: DataFrame, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id; of exact repeats of its row (id and text) one.

    Rows without an id and documents without shingles all stay. Columns as they are.
    """
    scratch = Scratch(docs.sparkSession)
    found = ngram_components(docs, size, id_col=id_col, text_col=text_col)
    later = found.where(F.col("component_id") < F.col(id_col))
    return one_of_each(docs, later, found.where("n_shingles > 0"), scratch, id_col, text_col)
