"""Line dedup: exact set-similarity join of lines, by prefix, positional and length filters.

A line's tokens are its distinct words (A-Z lower-cased); lines of at least ``least`` of them take part, by default
all that have a word. Two lines match when the Jaccard similarity of their token sets is ``num/den`` or more. A line is removed when any earlier
line matches it, earlier by document id, then by place; other lines are left as they are.

**Classes.** Lines with equal token sets are one class, collapsed within chunks before a shuffle and then by their digests;
only its first line, the head, can stay, and only heads take part in what follows.
**Prefix.** Tokens are ordered by rarity, by counts over all documents in a table of fixed size, and the hash among equals.
Sets that match share one of their first ``n - ceil(n * num / den) + 1`` tokens. Each is a posting: token, line, size,
place, and a parity sketch of the set of 112 bits. Tokens stand there with 32 bits of their hash, which their order follows;
others of the same 32 bits are further candidates only, as a set is then one of numbers that may repeat, and its overlap is no smaller. Sets of more than ``WIDE_FROM`` tokens, whose difference from any other would fill
it, have a second one with a bit or more for each token, up to 512; beyond 1,000 tokens that fills up too, and exact verification decides alone.
**Candidates.** Postings stream through partitions sorted by token and order of lines. A head is held against the ``WINDOW`` postings
before it by size, by what the places leave to share and by the sketches, whose distance bounds the symmetric difference from
below. The nearest by sketch goes to verification. Unless its distance is well below the limit, up to ``OTHERS`` candidates are listed beside it; if
there may be more that are not listed, the posting has a mark. Tokens with more than a 4,096th of all words are split over several tasks by the head; their heads are marked.
**Verify.** Exact Jaccard decides. For heads with no match, a second round verifies every remaining candidate: those listed, and
those from a join of their marked postings with all postings of these tokens. So near copies by the thousand are each settled
by one pair, and nothing is capped.
**Texts** stay where they are: the lists of lines to take out, about a hundredth of their size, go to the tasks, dealt by id to pieces of
``PIECE`` bytes, each looked up in a pass over the documents it is for. Only where they are more than ``PIECES`` pieces, texts are shuffled to them.

Null and empty texts have no lines that take part. Rows without an id are left as they are; of repeated ids, each row
loses the same lines, as the lines of equal ids at equal places are one line. Columns besides id and text play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    BUCKET_BITS, IdFilter, Scratch, bucket_counts, bucket_of, free_name, hash_words, list_array, mix, record_batch, signed, text_chunks,
)

NUM, DEN, LEAST = 80, 100, 1
REMOVED = "_removed"
WINDOW = 1024  # postings of a token that one is held against in the first round
SKETCH_BITS = 48  # in the number that also holds the place; 64 more follow
PLACES = 1 << 14  # places beyond are kept as the last one, which the positional filter lets pass
SPLIT_ROWS, SPLIT_SHARE = 1 << 16, 1 << 12
PAIRS = 1 << 16  # pairs that are compared at once
WIDE_FROM, WIDE_WORDS = 144, 8  # sets of more tokens have a second sketch, of a power of two of 64-bit words
OTHERS = 64  # candidates of a posting that are listed
PIECE, PIECES = 1 << 26, 4  # bytes of lists of removed lines that are looked up at once, and how many such pieces at most


class Lines:
    """The lines of a chunk of texts: distinct tokens sorted by line and hash, and where each line is."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, least: int):
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[1:] = data == 10
        begins[-1] = False
        begins[bounds[:-1]] = True
        starts = np.flatnonzero(begins)
        self.text = np.searchsorted(bounds, starts, side="right") - 1
        self.line = np.arange(len(starts)) - np.searchsorted(starts, bounds[self.text])
        words = hash_words(data, np.append(starts, len(data)))
        owner = np.repeat(np.arange(len(starts)), words.counts)
        order = sorted_within(owner, words.hashes, len(starts))
        owner, tokens = owner[order], words.hashes[order]
        new = np.ones(len(tokens), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (tokens[1:] != tokens[:-1])
        owner, tokens = owner[new], tokens[new]
        sizes = np.bincount(owner, minlength=len(starts))
        self.taken = np.flatnonzero(sizes >= least)
        keep = sizes[owner] >= least
        self.tokens, self.sizes = tokens[keep], sizes[self.taken]
        self.first = np.cumsum(self.sizes) - self.sizes

    def digest(self) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.first):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        scrambled = mix(self.tokens ^ np.uint64(0x5851F42D4C957F2D))
        return np.add.reduceat(mix(self.tokens), self.first), np.add.reduceat(scrambled, self.first)


def sorted_within(owner: np.ndarray, values: np.ndarray, owners: int) -> np.ndarray:
    """The order by owner, then by value; among equals as they come."""
    order = np.argsort(values, kind="stable")
    narrow = np.uint16 if owners <= 1 << 16 else np.int64  # narrow numbers are sorted by digits
    return order[np.argsort(owner[order].astype(narrow), kind="stable")]


def chunks(texts: pa.Array, least: int):
    for at, data, bounds in text_chunks(texts):
        if len(data):
            yield at, Lines(data, bounds, least)


def parities(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Of each set, the parities of its tokens in 112 buckets, as words of 48 and 64 bits."""
    place = (tokens >> np.uint64(9)) % np.uint64(SKETCH_BITS + 64)
    low = place < SKETCH_BITS
    bit = np.uint64(1) << np.where(low, place, place - np.uint64(SKETCH_BITS))
    none = np.uint64(0)
    return [np.bitwise_xor.reduceat(np.where(own, bit, none), first) for own in (low, ~low)]


def wide_parities(tokens: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Of each set of more than WIDE_FROM tokens, the parities of its tokens in as many buckets or more, 512 at most; null for others."""
    long = sizes > WIDE_FROM
    words = np.where(long, np.minimum(WIDE_WORDS, 1 << np.ceil(np.log2(np.maximum(sizes, 64) / 64)).astype(np.int64)), 0)
    offsets = np.append(0, np.cumsum(words))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    taken = long[owner]
    owner, tokens = owner[taken], tokens[taken]
    place = offsets[owner] * 64 + ((tokens >> np.uint64(40)).astype(np.int64) & (words[owner] * 64 - 1))
    odd = np.bincount(place, minlength=int(offsets[-1]) * 64).astype(np.uint8) & 1
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.packbits(odd, bitorder="little").view(np.int64)), mask=pa.array(~long))


def wide_apart(wide: pa.Array, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distances of the wide sketches of rows x and y, 0 where one has none; of two sizes, the larger is folded."""
    apart = np.zeros(len(x), dtype=np.int64)
    words = pc.fill_null(pc.list_value_length(wide), 0).to_numpy().astype(np.int64)
    flat, first = wide.flatten().to_numpy(), np.cumsum(words) - words
    both = np.flatnonzero((words[x] > 0) & (words[y] > 0))
    kinds = words[x[both]] * (WIDE_WORDS + 1) + words[y[both]]
    for kind in np.unique(kinds).tolist():
        own = both[kinds == kind]
        sketches = []
        for rows, width in zip((x[own], y[own]), divmod(kind, WIDE_WORDS + 1)):
            bits = flat[first[rows][:, None] + np.arange(width)]
            while bits.shape[1] > min(divmod(kind, WIDE_WORDS + 1)):
                half = bits.shape[1] // 2
                bits = bits[:, :half] ^ bits[:, half:]
            sketches.append(bits)
        apart[own] = np.bitwise_count((sketches[0] ^ sketches[1]).view(np.uint64)).sum(axis=1)
    return apart


def prefixes(tokens: np.ndarray, owner: np.ndarray, sizes: np.ndarray, counts: np.ndarray, num: int, den: int) -> pa.Array:
    """Of each set, 32 bits of the tokens of its prefix. The order by rarity is an order of these 32 bits too."""
    short = (tokens >> np.uint64(24)).astype(np.uint32)
    rarity = (counts[bucket_of(tokens)] << np.uint64(40)) | short.astype(np.uint64)
    short = short[sorted_within(owner, rarity, len(sizes))]
    length = sizes - -(-sizes * num // den) + 1
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    offsets = np.append(0, np.cumsum(length)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(short[within < length[owner]].view(np.int32)))


CLASS = ["h1", "h2", "n"]
LINES = "h1 long, h2 long, n int, doc_id long, line int, docs array<long>, lines array<int>, prefix array<int>, sketch long, sketch2 long, wide array<long>"


def lines_of(docs: DataFrame, counts: np.ndarray, least: int, num: int, den: int) -> DataFrame:
    """A row for each class of lines in a chunk: its first line, the others, its prefix by rarity and its sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 24) - 1).astype(np.uint64))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, own in chunks(batch.column(1), least):
                if not len(own.taken):
                    continue
                h1, h2 = own.digest()
                doc, line = ids[own.text[own.taken] + at], own.line[own.taken]
                order = np.lexsort((line, doc, h2, h1))
                new = np.ones(len(order), dtype=bool)
                new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
                heads = order[new]
                group = np.cumsum(new) - 1
                # Rows of one id may repeat a line; that is no copy.
                other = (doc[order] != doc[heads][group]) | (line[order] != line[heads][group])
                others = order[other]
                copies = pa.array(np.append(0, np.cumsum(np.bincount(group[other], minlength=len(heads)))).astype(np.int32))
                sketch, more = parities(own.tokens, own.first)
                # The tokens of the heads, each head's by rarity.
                sizes = own.sizes[heads]
                local = np.repeat(np.arange(len(heads)), sizes)
                within = np.arange(len(local)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                tokens = own.tokens[np.repeat(own.first[heads], sizes) + within]
                wide = wide_parities(tokens, sizes)
                prefix = prefixes(tokens, local, sizes, shared.value, num, den)
                yield record_batch(
                    h1=pa.array(signed(h1[heads])), h2=pa.array(signed(h2[heads])), n=pa.array(sizes.astype(np.int32)),
                    doc_id=pa.array(doc[heads]), line=pa.array(line[heads].astype(np.int32)),
                    docs=pa.ListArray.from_arrays(copies, pa.array(doc[others])), lines=pa.ListArray.from_arrays(copies, pa.array(line[others].astype(np.int32))),
                    prefix=prefix,
                    sketch=pa.array(signed(sketch[heads])), sketch2=pa.array(signed(more[heads])), wide=wide,
                )

    return docs.select("doc_id", "text").mapInArrow(run, LINES)


def mark_heads(lines: DataFrame) -> DataFrame:
    """The rows of ``lines_of`` with ``head``, whether it is the first line of its class, and ``copy``, whether it is a later one.

    Only heads keep their prefix. (A row that is neither repeats the head's row.)
    """

    def run(batches):
        last = None  # class and place of the open class's head
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, n, doc, line = [batch.column(i).to_numpy() for i in range(5)]
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (n[1:] != n[:-1])
            goes_on = last is not None and last[:3] == (h1[0], h2[0], n[0])
            new[0] = not goes_on
            start = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            head_doc, head_line = doc[start], line[start]
            if goes_on:
                until = int(np.argmax(new)) if new.any() else len(new)
                head_doc[:until], head_line[:until] = last[3:]
            last = (h1[-1], h2[-1], n[-1], head_doc[-1], head_line[-1])
            copy = (doc != head_doc) | (line != head_line)
            prefix = batch.column(7)
            prefix = pc.if_else(pa.array(new), prefix, pa.scalar(None, prefix.type))
            wide = pc.if_else(pa.array(new), batch.column(10), pa.scalar(None, batch.column(10).type))
            yield record_batch(
                doc_id=batch.column(3), line=batch.column(4), docs=batch.column(5), lines=batch.column(6), prefix=prefix,
                sketch=batch.column(8), sketch2=batch.column(9), wide=wide, n=batch.column(2), head=pa.array(new), copy=pa.array(copy),
            )

    schema = "doc_id long, line int, docs array<long>, lines array<int>, prefix array<int>, sketch long, sketch2 long, wide array<long>, n int, head boolean, copy boolean"
    return lines.repartition(*CLASS).sortWithinPartitions(*CLASS, "doc_id", "line").mapInArrow(run, schema)


# In this order the zeros of short numbers lie together, and a shuffle's compression takes them out.
POSTING = ["place", "sketch2", "at", "doc_id", "token", "wide"]


def postings(heads: DataFrame, *more: str) -> DataFrame:
    """(place: place and first part of the sketch, sketch2, at: line and size, doc_id, token, wide) of the prefixes."""
    at = F.shiftleft(F.col("line").cast("long"), 32).bitwiseOR(F.col("n").cast("long")).alias("at")
    rows = heads.select(at, "doc_id", "sketch", "sketch2", "wide", *more, F.posexplode("prefix").alias("p", "token"))
    place = F.shiftleft(F.least(F.col("p"), F.lit(PLACES - 1)).cast("long"), SKETCH_BITS).bitwiseOR(F.col("sketch"))
    return rows.withColumn("place", place).select(*POSTING, *more)


def split_tokens(posted: DataFrame, counts: np.ndarray) -> DataFrame:
    """Postings with keys: of a token that very many words are, several; then the place has the mark PLACES."""
    most = max(SPLIT_ROWS, int(counts.sum()) // SPLIT_SHARE)
    often = np.flatnonzero(counts > most)  # fewer than SPLIT_SHARE
    if not len(often):
        return posted
    parts = posted.sparkSession.createDataFrame([(int(b), int(counts[b] // most + 1)) for b in often], "bucket int, parts long")
    bucket = F.col("token").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))
    dealt = posted.withColumn("bucket", bucket).join(F.broadcast(parts), "bucket", "left")
    key = F.hash("token", F.pmod(F.xxhash64("doc_id", "at"), F.col("parts")))
    place = F.col("place").bitwiseOR(F.lit(PLACES << SKETCH_BITS))
    split = F.col("parts").isNotNull()
    dealt = dealt.withColumns({"token": F.when(split, key).otherwise(F.col("token")), "place": F.when(split, place).otherwise(F.col("place"))})
    return dealt.select(POSTING)


FOUND = "doc_x long, line_x int, token int, doc_y long, line_y int, apart int, docs array<long>, lines array<int>, more boolean"


def nearest_earlier(posted: DataFrame, num: int, den: int, window: int) -> DataFrame:
    """For heads that pass the filters with an earlier one: the nearest such of a token, others listed, and whether there may be more.

    Rows come sorted by token, document and line. A task holds one batch and the ``window`` rows before it. A head
    with more rows of its token before it, or whose token was split (then null), has the mark, and may come without a partner.
    Candidates are listed where the nearest is nearer to the limit than to 0; elsewhere they are seldom needed.
    """

    def run(batches):
        held, held_wide, seen = None, None, 0  # the last rows of the open token, and how many it had
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, wide, old = [batch.column(c).to_numpy() for c in ("token", "at", "doc_id", "place", "sketch2")], batch.column("wide"), 0
            if held is not None and held[0][-1] == columns[0][0]:
                old = len(held[0])
                columns, wide = [np.concatenate([h, c]) for h, c in zip(held, columns)], pa.concat_arrays([held_wide, wide])
            token, at, doc, place, more_bits = columns
            rows = len(token)
            edges = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            start = np.repeat(edges, np.diff(np.append(edges, rows)))
            n, line = (at & 0xFFFFFFFF).astype(np.int32), at >> 32
            split = (place >> (SKETCH_BITS + 14)) & 1 == 1
            spot = ((place >> SKETCH_BITS) & (PLACES - 1)).astype(np.int32)
            bits = place & ((1 << SKETCH_BITS) - 1)
            index = np.arange(rows)
            begin = np.maximum(start, index - window)
            begin[:old] = index[:old]  # met in an earlier batch
            before = index - start + np.where(start == 0, seen - old, 0) if old else index - start
            beyond = split | (before > window)
            hits, nearest, partner = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64), np.full(rows, -1)
            listed, others = np.zeros(rows, dtype=np.int64), [np.zeros(0, dtype=np.int64)]
            lengths = index - begin
            ends = np.cumsum(lengths)
            done = old
            while done < rows:
                to = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS, side="right")))
                many = lengths[done:to]
                own = np.repeat(index[done:to], many)
                other = np.arange(len(own)) + np.repeat(begin[done:to] - (np.cumsum(many) - many), many)
                a, b = n[own], n[other]
                fits = np.flatnonzero((a * np.int64(den) >= b * np.int64(num)) & (b * np.int64(den) >= a * np.int64(num)))
                own, other, a, b = own[fits], other[fits], a[fits].astype(np.int64), b[fits].astype(np.int64)
                need = -(-(a + b) * num // (num + den))
                p, q = spot[own], spot[other]
                left = np.minimum(a - p, b - q) + np.minimum(p, q)
                apart = np.bitwise_count(bits[own] ^ bits[other]).astype(np.int64) + np.bitwise_count((more_bits[own] ^ more_bits[other]).view(np.uint64))
                near = (apart <= a + b - 2 * need) & ((left >= need) | (p == PLACES - 1) | (q == PLACES - 1))
                near &= (doc[own] != doc[other]) | (line[own] != line[other])
                own, other, apart, most = own[near], other[near], apart[near], (a + b - 2 * need)[near]
                apart = np.maximum(apart, wide_apart(wide, own, other))
                near = apart <= most
                own, other, apart, most = own[near], other[near], apart[near], most[near]
                if len(own):
                    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    x = own[first]
                    hits[x] = np.diff(np.append(first, len(own)))
                    best = np.minimum.reduceat((apart << 32) | other, first)
                    nearest[x], partner[x] = best >> 32, best & 0xFFFFFFFF
                    few = (hits[x] > 1) & (hits[x] <= OTHERS) & (2 * nearest[x] > most[first])
                    listed[x] = np.where(few, hits[x], 0)
                    others.append(other[np.repeat(few, hits[x])])
                done = to
            x = np.flatnonzero((hits > 0) | (beyond & (index >= old)))
            lacking = pa.array(partner[x] < 0)
            none = lambda values: pc.if_else(lacking, pa.scalar(None, values.type), values)
            offsets, every = pa.array(np.append(0, np.cumsum(listed[x])).astype(np.int32)), np.concatenate(others)
            yield record_batch(
                doc_x=pa.array(doc[x]), line_x=pa.array(line[x].astype(np.int32)), token=pa.array(token[x], mask=split[x]),
                doc_y=none(pa.array(doc[partner[x]])), line_y=none(pa.array(line[partner[x]].astype(np.int32))),
                apart=pa.array(nearest[x].astype(np.int32)), docs=pa.ListArray.from_arrays(offsets, pa.array(doc[every])),
                lines=pa.ListArray.from_arrays(offsets, pa.array(line[every].astype(np.int32))), more=pa.array((hits[x] > np.maximum(listed[x], 1)) | beyond[x]),
            )
            last = int(start[-1])
            seen = rows - last + (seen - old if old and last == 0 else 0)
            held, held_wide = [c[max(last, rows - window) :] for c in columns], wide.slice(max(last, rows - window))

    return posted.repartition("token").sortWithinPartitions("token", "doc_id", "at").mapInArrow(run, FOUND)


def removed_lines(docs: DataFrame, num: int = NUM, den: int = DEN, least: int = LEAST, window: int = WINDOW) -> DataFrame:
    """(doc_id, line) of the lines to remove; ``docs`` has doc_id and text."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    counts = bucket_counts(docs.select("text"), lambda batch: (hash_words(data, bounds).hashes for _, data, bounds in text_chunks(batch.column(0))))
    marked = scratch.keep(mark_heads(lines_of(docs, counts, least, num, den)))
    posted = postings(marked.where("head"))
    found = scratch.keep(nearest_earlier(split_tokens(posted, counts), num, den, window))
    spot_x, pair = ["doc_x", "line_x"], ["doc_x", "line_x", "doc_y", "line_y"]
    best = F.min(F.struct("apart", "doc_y", "line_y")).alias("y")
    pairs = scratch.keep(found.where("doc_y IS NOT NULL").groupBy(*spot_x).agg(best).select(*spot_x, F.col("y.doc_y").alias("doc_y"), F.col("y.line_y").alias("line_y")))
    matched = _verified(scratch, docs, pairs, num, den, least)
    left = found.join(matched, spot_x, "left_anti")
    rest = left.where("doc_y IS NOT NULL").select(pair).unionByName(left.select(*spot_x, F.inline(F.arrays_zip("docs", "lines")).alias("doc_y", "line_y")))
    again = scratch.keep(left.where("more").select(*spot_x, "token"))
    if not again.isEmpty():
        rest = rest.unionByName(earlier_candidates(again, marked, num, den))
    rest = scratch.keep(rest.distinct().join(pairs, pair, "left_anti"))
    if not rest.isEmpty():
        matched = scratch.keep(matched.unionByName(_verified(scratch, docs, rest, num, den, least)))
    copies = marked.where("size(docs) > 0").select(F.inline(F.arrays_zip("docs", "lines"))).toDF("doc_id", "line")
    copies = copies.unionByName(marked.where("copy").select("doc_id", "line"))
    return copies.unionByName(matched.select(F.col("doc_x").alias("doc_id"), F.col("line_x").alias("line")))


def earlier_candidates(again: DataFrame, marked: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs (later head, earlier head) that share a token of the later one in ``again`` and pass the filters; a null stands for its prefix.

    Tokens of its prefix that are not there have had all their pairs listed.
    """
    heads = marked.where("head").select("doc_id", "line", "n", "prefix", "sketch", "sketch2", "wide")
    again = again.groupBy("doc_x", "line_x").agg(F.collect_set("token").alias("asked"), F.max(F.col("token").isNull()).alias("whole"))
    wanted = heads.join(again, (F.col("doc_id") == F.col("doc_x")) & (F.col("line") == F.col("line_x")))
    own = postings(wanted, "prefix", "asked", "whole").where(F.col("whole") | F.array_contains("asked", F.col("token"))).drop("asked", "whole")
    asked = IdFilter(own, "token", hashed=True)
    table, mask = asked.table, (1 << asked.bits) - 1

    def asked_postings(batches):
        """The postings whose token may be asked for."""
        for batch in batches:
            doc, line, n, prefix, sketch, sketch2 = batch.columns[:6]
            tokens, sizes = prefix.flatten().to_numpy(), pc.list_value_length(prefix).to_numpy()
            places = tokens & mask
            hit = np.flatnonzero((table.value[places >> 5] >> (places & 31)) & 1)
            row = np.repeat(np.arange(len(sizes)), sizes)[hit]
            first = (np.cumsum(sizes) - sizes)[row]
            spot = np.minimum(hit - first, PLACES - 1)
            before = {f"before{k}": pa.array(tokens[np.maximum(hit - k, 0)], mask=hit - k < first) for k in (1, 2)}
            at = (line.to_numpy().astype(np.int64) << 32) | n.to_numpy()
            yield record_batch(
                token=pa.array(tokens[hit]), at=pa.array(at[row]), doc_id=doc.take(pa.array(row)),
                place=pa.array((spot << SKETCH_BITS) | sketch.to_numpy()[row]), sketch2=sketch2.take(pa.array(row)), **before,
            )

    held = heads.drop("wide").mapInArrow(asked_postings, "token int, at long, doc_id long, place long, sketch2 long, before1 int, before2 int")
    x = own.select("token", "prefix", *[F.col(c).alias(f"{c}_x") for c in POSTING[:4]])
    y = held.select("token", "before1", "before2", *[F.col(c).alias(f"{c}_y") for c in POSTING[:4]])
    a, b = (F.col(f"at_{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in "xy")
    line_x, line_y = (F.shiftright(f"at_{k}", 32) for k in "xy")
    need = F.floor(((a + b) * num + (num + den - 1)) / (num + den))
    p, q = (F.shiftright(f"place_{k}", SKETCH_BITS) for k in "xy")
    left = F.least(a - p, b - q) + F.least(p, q)
    mask_bits = F.lit((1 << SKETCH_BITS) - 1)
    apart = F.bit_count(F.col("place_x").bitwiseXOR(F.col("place_y")).bitwiseAND(mask_bits)) + F.bit_count(F.col("sketch2_x").bitwiseXOR(F.col("sketch2_y")))
    fits = (a * den >= b * num) & (b * den >= a * num)
    earlier = (F.col("doc_id_y") < F.col("doc_id_x")) | ((F.col("doc_id_y") == F.col("doc_id_x")) & (line_y < line_x))
    share = (left >= need) | (p == PLACES - 1) | (q == PLACES - 1)
    # A pair meets under every token that both prefixes have. One whose last or last but one token is shared too has met before.
    met = [F.coalesce(F.array_contains("prefix", F.col(f"before{k}")), F.lit(False)) for k in (1, 2)]
    pairs = x.join(y, "token").where(earlier & fits & share & (apart <= a + b - 2 * need) & ~(met[0] | met[1]))
    return pairs.select(
        F.col("doc_id_x").alias("doc_x"), line_x.cast("int").alias("line_x"), F.col("doc_id_y").alias("doc_y"), line_y.cast("int").alias("line_y")
    ).distinct()


def _spots(docs: np.ndarray, lines: np.ndarray) -> np.ndarray:
    return signed(mix(mix(docs.view(np.uint64)) + lines.astype(np.uint64)))


def _verified(scratch: Scratch, docs: DataFrame, pairs: DataFrame, num: int, den: int, least: int) -> DataFrame:
    """The later lines of kept pairs whose token sets match."""
    ends = [pairs.select(F.col(f"doc_{k}").alias("doc_id"), F.col(f"line_{k}").alias("line")) for k in "xy"]

    def with_spot(batches):
        for batch in batches:
            spots = _spots(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield record_batch(doc_id=batch.column(0), line=batch.column(1), spot=pa.array(spots))

    wanted = scratch.keep(ends[0].unionByName(ends[1]).distinct().mapInArrow(with_spot, "doc_id long, line int, spot long"))
    # Bit maps leave out documents, and then lines, that surely have none; exact joins follow.
    bits = min(26, max(20, (16 * wanted.count()).bit_length()))
    of_docs, of_lines = IdFilter(wanted, "doc_id"), IdFilter(wanted, "spot", bits, hashed=True)
    doc_table, line_table, hits, mask = of_docs.table, of_lines.table, of_docs.hits, (1 << bits) - 1

    def run(batches):
        for batch in batches:
            batch = batch.filter(hits(doc_table.value, batch.column(2)))
            ids = batch.column(0).to_numpy()
            for at, own in chunks(batch.column(1), least):
                doc, line = ids[own.text[own.taken] + at], own.line[own.taken]
                asked = np.flatnonzero(hits(line_table.value, pa.array(_spots(doc, line) & mask)).to_numpy(zero_copy_only=False))
                sets = [signed(own.tokens[b : b + n]) for b, n in zip(own.first[asked].tolist(), own.sizes[asked].tolist())]
                yield record_batch(doc_id=pa.array(doc[asked]), line=pa.array(line[asked].astype(np.int32)), tokens=list_array(sets, pa.int64()))

    sets = docs.select("doc_id", "text", of_docs.place("doc_id")).mapInArrow(run, "doc_id long, line int, tokens array<long>")
    sets = scratch.keep(sets)  # the joins with pairs leave out the few that are not wanted
    x = sets.select(F.col("doc_id").alias("doc_x"), F.col("line").alias("line_x"), F.col("tokens").alias("sx"))
    y = sets.select(F.col("doc_id").alias("doc_y"), F.col("line").alias("line_y"), F.col("tokens").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    found = pairs.join(x, ["doc_x", "line_x"]).join(y, ["doc_y", "line_y"]).withColumn("both", both)
    found = found.where(F.col("both") * den >= (F.size("sx") + F.size("sy") - F.col("both")) * num)
    found = scratch.keep(found.select("doc_x", "line_x").distinct())
    for kept in (sets, wanted):
        scratch.drop(kept)
    return found


def dedup_lines(docs: DataFrame, num: int = NUM, den: int = DEN, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the later matches taken out of the text; all rows and columns stay, and ``_removed`` counts the lines
    (``_removed_`` where the input has that name)."""
    scratch = Scratch(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gone = removed_lines(named, num, den, least).groupBy("doc_id").agg(F.array_sort(F.collect_set("line")).alias("lines"))
    name, lines, removed = (free_name(n, docs) for n in ("_id", "_lines", REMOVED))
    gone = scratch.keep(gone.select(F.col("doc_id").alias(name), F.col("lines").alias(lines)))
    pieces = max(1, -(-(gone.agg(F.sum(F.size(lines) * 4 + 12)).first()[0] or 0) // PIECE))
    if pieces <= PIECES:
        whole = F.col(id_col).cast("long")
        key = F.when(whole == F.col(id_col), whole)
        parts = []
        for k in range(pieces):
            piece = lambda id: F.pmod(F.xxhash64(id), F.lit(pieces)) == k  # noqa: B023, E731
            lookup = looked_up(gone.where(piece(F.col(name))))
            parts.append((docs.where(piece(key)) if pieces > 1 else docs).withColumn(lines, lookup(key)))
    else:
        maybe, rest = IdFilter(gone, name).parts(docs, id_col)
        parts = [rest.withColumn(lines, F.lit(None).cast("array<int>")), maybe.join(gone, F.col(id_col) == F.col(name), "left")]
    kept = F.filter(F.split(text_col, "\n", -1), lambda x, i: ~F.array_contains(lines, i))
    text = F.when(F.col(lines).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    count = F.when(F.col(lines).isNull(), 0).otherwise(F.size(F.col(lines))).cast("long")
    columns = [text.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    first, *others = [part.select(*columns, count.alias(removed)) for part in parts]
    for other in others:
        first = first.unionByName(other)
    return first


def looked_up(lists: DataFrame):
    """A function from an id to its list of lines, null for other ids; ``lists`` has an id, once, and its list, and goes to the tasks."""
    held = lists.toArrow()
    ids, own = (held.column(c).combine_chunks() for c in range(2))
    order = np.argsort(ids.to_numpy())
    own = own.take(pa.array(order))
    ends = np.append(0, np.cumsum(pc.list_value_length(own).to_numpy())).astype(np.int32)
    flat = own.flatten().to_numpy()
    if len(flat) and flat.max() < 1 << 16:
        flat = flat.astype(np.uint16)
    # The last id stands for all beyond; its list is empty.
    table = lists.sparkSession.sparkContext.broadcast((np.append(ids.to_numpy()[order], np.iinfo(np.int64).max), np.append(ends, ends[-1]), flat))

    @F.arrow_udf("array<int>")
    def lookup(keys: pa.Array) -> pa.Array:
        ids, ends, flat = table.value
        key = pc.fill_null(keys, 0).to_numpy()
        spot = np.searchsorted(ids, key)
        sizes = np.where((ids[spot] == key) & keys.is_valid().to_numpy(zero_copy_only=False), ends[spot + 1] - ends[spot], 0)
        offsets = np.append(0, np.cumsum(sizes))
        values = flat[np.arange(offsets[-1]) + np.repeat(ends[spot] - offsets[:-1], sizes)]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)), mask=pa.array(sizes == 0))

    return lookup


def digest(deduped: DataFrame) -> DataFrame:
    """Per document: lines removed, lines left and a checksum of the text that is left."""
    text = F.coalesce("text", F.lit(""))
    return deduped.select("doc_id", F.col("_removed").alias("n_removed"), F.length(text).cast("long").alias("n_chars_left"), F.sha2(text, 256).alias("text_sha256"))


def with_lengths(deduped: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``length_col`` set to the text's length in the rows that lost lines; other rows keep theirs."""
    changed = F.when(F.col("_removed") > 0, F.length(text_col)).otherwise(F.col(length_col))
    return deduped.withColumn(length_col, changed.cast(deduped.schema[length_col].dataType))
