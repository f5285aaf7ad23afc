"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

**Signature.** Each distinct shingle draws one random permutation of the ``slots`` and meets them in that order: at level j
it offers the value (j, a random number) to its j-th slot, and a slot keeps its least value. So the ranks that one
element gives to the slots are correlated: each slot gets another rank, which lowers the variance of the estimate against independent
hashes. Offers of a later level never beat those of an earlier one, so a document stops at the first level after
which all its slots are filled: after one level for long documents. Permutations are shuffled step by step, only as far as they are read.
**Banding.** ``bands`` bands of ``rows`` slots: sets that are linked agree in a whole band, but for a probability of
(1 - 0.85^5)^25 = 4e-7 at the least similarity and the defaults. Equal sets are one class before, so copies never meet.
**Verification.** Under a key, members are held against one pivot first, the class that shares most keys with others. Links that
the full sets confirm are contracted. Then keys whose members are not all in one component go on: pivots are drawn by hash, ``GROWTH``
times as many each round until all members are, and held against members of other components. Two bits of each slot rule out pairs
far below the threshold (six standard deviations), and small parity sketches of the sets, whose distance bounds the symmetric
difference from below, rule out most others, so near misses by the thousand are not paired. Sets meet in groups of bounded size: a pivot's members are dealt
to groups by the total size of their sets. **Union-find.** Confirmed links are grouped by hooking and pointer jumping.

Every candidate pair that is not ruled out and not in one component is verified, however full its key. Defined results: null
and empty texts, and texts of white space, have no shingles and are linked with nothing. Repeated rows give rows each; rows of
one id with different texts are told apart by their sets. A null id gives a null component and null ``kept``, and links nothing.
Columns besides id and text play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    CLASS, Links, Scratch, apart_sql, components, digests, list_array, mix, one_of_each, parities, record_batch, set_pieces, signed,
)

NUM, DEN, SIZE = 85, 100, 5
BANDS, ROWS = 25, 5
GROWTH = 8
_LEVEL = np.uint64(56)


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures (one row per set, which is not empty): level in the upper 8 bits, a random number below."""
    if not 0 < slots < 256:
        raise ValueError("A signature has 1 to 255 slots.")
    out = np.full((len(sets), slots), np.uint64(0xFFFFFFFFFFFFFFFF))
    if sets:
        _fill(sets, out)
    return out


def _fill(sets: list[np.ndarray], out: np.ndarray) -> None:
    slots = out.shape[1]
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    state = mix(np.concatenate(sets) ^ np.uint64(0x2545F4914F6CDD1D))
    flat = out.ravel()  # a view: rows lie one after another
    order = None  # the permutations, as far as they are shuffled
    for level in range(slots):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        # The upper bits choose the slot, the lower ones are the value.
        step = (((state >> np.uint64(32)) * np.uint64(slots - level)) >> np.uint64(32)).astype(np.int64) + level
        if order is None:
            slot = step
        else:
            line = np.arange(len(own))
            slot = order[line, step].astype(np.int64)
            order[line, step] = order[:, level]
        value = (np.uint64(level) << _LEVEL) | (mix(state ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(8))
        np.minimum.at(flat, own * slots + slot, value)
        open_ = (out >> _LEVEL).max(axis=1) > level  # some slot is not filled yet
        stay = open_[own]
        if not stay.any():
            return
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8), (int(stay.sum()), 1))
            line = np.arange(len(order))
            order[line, step[stay]] = 0
            own, state = own[stay], state[stay]
        elif not stay.all():
            order, own, state = order[stay], own[stay], state[stay]


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    n = len(signatures)
    parts = mix(signatures).reshape(n, bands, rows) * (np.arange(1, 2 * rows, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
    return mix(parts.sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def planes(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each slot, as two bit maps of 64-bit words each."""
    n, slots = signatures.shape
    words = -(-slots // 64)
    scrambled, out = mix(signatures), np.zeros((n, 2, words * 64), dtype=np.uint8)
    for k in (0, 1):
        out[:, k, :slots] = (scrambled >> np.uint64(11 + k)) & np.uint64(1)
    return np.packbits(out, axis=2, bitorder="little").view(np.int64).reshape(n, 2 * words)


def most_apart(slots: int, num: int, den: int) -> int:
    """Slots whose two bits differ in a linked pair: mean of the least similar ones and six standard deviations."""
    p = 0.75 * (1 - num / den)
    return int(np.ceil(slots * p + 6 * np.sqrt(slots * p * (1 - p))))


def _apart(words: int) -> str:
    """SQL for the number of slots whose two bits differ, of rows with bits_u and bits_v."""
    return " + ".join(f"bit_count((bits_u[{i}] ^ bits_v[{i}]) | (bits_u[{words + i}] ^ bits_v[{words + i}]))" for i in range(words))


SIGNED = "doc_id {id}, n_shingles long, h1 long, h2 long, bits array<long>, keys array<long>, sketch array<long>"


def signatures(docs: DataFrame, size: int = SIZE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Of each row of (doc_id, text): set size, digests of the set, two bits of each slot, the band keys and a parity sketch.

    Rows without an id and sets met shortly before have their digests only.
    """

    def run(batches):
        for batch in batches:
            for at, sets in set_pieces(batch.column(1), size):
                ids = batch.column(0).slice(at, len(sets))
                h1, h2 = digests(sets)
                valid = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False) & (np.array([len(s) for s in sets]) > 0))
                full = valid[np.unique(np.stack([h1, h2])[:, valid], axis=1, return_index=True)[1]].tolist()
                found = superminhash([sets[i] for i in full], bands * rows)
                none = np.zeros(0, np.int64)
                bits, keys, sketch = [none] * len(sets), [none] * len(sets), [none] * len(sets)
                for i, own_bits, own_keys in zip(full, planes(found), signed(band_keys(found, bands, rows))):
                    bits[i], keys[i], sketch[i] = own_bits, own_keys, parities(sets[i])
                yield record_batch(
                    doc_id=ids, n_shingles=pa.array([len(s) for s in sets], pa.int64()), h1=pa.array(h1), h2=pa.array(h2),
                    bits=list_array(bits, pa.int64()), keys=list_array(keys, pa.int64()), sketch=list_array(sketch, pa.int64()),
                )

    return docs.select("doc_id", "text").mapInArrow(run, SIGNED.format(id=docs.schema["doc_id"].dataType.simpleString()))


def near_duplicates(
    docs: DataFrame,
    size: int = SIZE,
    num: int = NUM,
    den: int = DEN,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept): sets are linked when den * |A & B| >= num * |A | B|."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed_rows = scratch.keep(signatures(texts, size, bands, rows))
    owners = signed_rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = owners.groupBy(*CLASS).agg(F.min("doc_id").alias("rep"), *[F.max(c).alias(c) for c in ("bits", "keys", "sketch")])
    classes = scratch.keep(classes.withColumn("cid", F.monotonically_increasing_id()))
    keyed = classes.select("cid", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    signed_classes = classes.select("cid", "bits", F.col("n_shingles").alias("size"))
    members = scratch.keep(keyed.join(shared, "key").join(signed_classes, "cid"))
    linked = grouped(Links(texts, classes, scratch, size, num, den), members, bands * rows)
    groups = classes.join(linked.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    least = groups.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = groups.join(least, "component").select(*CLASS, "component_id")
    found = signed_rows.select("doc_id", *CLASS).join(named, CLASS, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    found = found.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"))
    found = scratch.keep(found.withColumn("kept", F.col(id_col) == F.col("component_id")))
    for kept in (signed_rows, classes, members):
        scratch.drop(kept)
    return found


def grouped(links: Links, members: DataFrame, slots: int) -> DataFrame:
    """Components (id, component) of the classes, from members (key, n, cid, bits, size) of keys with n classes."""
    scratch, words = links.scratch, -(-slots // 64)
    near = F.expr(_apart(words)) <= most_apart(slots, links.num, links.den)
    weights = members.groupBy("cid").agg(F.sum("n").alias("weight"))
    weighted = members.join(weights, "cid")
    pivots = weighted.groupBy("key").agg(F.max(F.struct("weight", "cid", "bits", "size")).alias("p"))
    pivots = pivots.select("key", F.col("p.cid").alias("pivot"), F.col("p.bits").alias("bits_u"), F.col("p.size").alias("a"))
    star = members.withColumnsRenamed({"cid": "member", "bits": "bits_v", "size": "b"}).join(pivots, "key")
    star = star.where("member <> pivot").where(links.fits("a", "b") & near).select("pivot", "member")
    tested = scratch.keep(star.distinct())
    found = links.confirmed(tested)
    linked = components(found, scratch)
    open_members, share = members, 1
    while True:
        labelled = open_members.join(linked.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
        mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        open_members = scratch.keep(labelled.join(mixed, "key"))
        open_members = open_members.where(F.col("n") > max(share, 2))  # in other keys all members have been pivots, or both have met
        if open_members.isEmpty():
            return linked
        # Drawn by hash: about ``share`` of a key's members, all of them in the last round.
        share *= GROWTH
        lot = F.pmod(F.xxhash64("key", "cid"), F.lit(1 << 30)) * F.col("n")
        sketched = open_members.join(links.classes.select("cid", "sketch"), "cid")
        names = {"cid": "pivot", "bits": "bits_u", "size": "a", "component": "c", "sketch": "sketch_u"}
        pivots = sketched.where(lot < F.lit((1 << 30) * share)).withColumnsRenamed(names).select("key", *names.values())
        pairs = sketched.withColumnsRenamed({"cid": "member", "bits": "bits_v", "size": "b", "sketch": "sketch_v"}).join(pivots, "key")
        most = (F.col("a") + F.col("b")) * (links.den - links.num)
        differ = F.expr(apart_sql("sketch_u", "sketch_v")) * (links.den + links.num) <= most
        pairs = pairs.where((F.col("component") != F.col("c")) & links.fits("a", "b") & near & differ)
        pairs = pairs.select(F.least("pivot", "member").alias("pivot"), F.greatest("pivot", "member").alias("member")).distinct()
        old = tested.select(F.least("pivot", "member").alias("pivot"), F.greatest("pivot", "member").alias("member"))
        pairs = scratch.keep(pairs.join(old, ["pivot", "member"], "left_anti"))
        open_members = open_members.drop("component")
        if not pairs.isEmpty():
            new = links.confirmed(pairs)
            tested = scratch.keep(tested.unionByName(pairs))
            if not new.isEmpty():
                found = scratch.keep(found.unionByName(new))
                linked = components(found, scratch)


def drop_near_duplicates(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group stays, the one with the smallest id; of exact repeats of its row (id and text) one.

    Rows without an id and documents without shingles all stay. Columns as they are.
    """
    scratch = Scratch(docs.sparkSession)
    found = near_duplicates(docs, size, num, den, id_col=id_col, text_col=text_col)
    return one_of_each(docs, found.where("NOT kept"), found.where("n_shingles > 0"), scratch, id_col, text_col)
