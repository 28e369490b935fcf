"""Near-duplicate documents by Order MinHash, verified by banded alignment.

The k-mers of a document are its runs of ``K`` words; the i-th occurrence of a k-mer is told apart from the others.  A
sketch is the ``PICK`` occurrence-labelled k-mers with the smallest keyed hashes, *in text order*; two documents agree on
it with a probability that falls with edits and with reordering.  ``BANDS`` sketches are made, each under its own key;
documents of few k-mers have ``SMALL_BANDS`` sketches of ``SMALL_PICK`` k-mers (documents near the boundary have both).
Two documents with similarity 0.8 agree on a sketch with a probability of about 0.8^6 = 0.26, and on none of 64 with one
of about 4e-9.

Documents that agree on a sketch are candidates.  They are verified on their texts: the longest alignment of labelled
k-mers that stays inside a band; similarity = aligned / (all of both - aligned), at least ``LEAST``.  The band is as wide
as an alignment of that similarity can stray, so it loses none.  Classes are the connected components of the verified
pairs.

Documents with equal words are one vertex from the start, however many there are.  In a bucket, all members are first
compared with one of them only, the one that meets most others in all buckets: the text that the rest are copies of.  Once
those links have joined vertices to components, the members that are still in different components are compared with each
other, all that were met around one centre: in blocks of ``BLOCK``, a task for each pair of blocks, which counts common k-mers
by an index and aligns only what these allow.  A task gives a link for each pair of components it finds joined; pairs of documents are not spelled out.
So a large group of near copies costs its size in rows; what its members leave open costs comparisons, not rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricemill.llm.common import keep

K = 5
LEAST = 0.8
BANDS, PICK = 64, 6
SMALL_BANDS, SMALL_PICK = 16, 2
SMALL = 40  # documents of up to so many k-mers take the small sketches, those of LEAST * SMALL or more the large ones
SEED = 11
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xC2B2AE3D27D4EB4F)
BLOCK = 256  # documents of a block
PART = 1 << 21  # cells of the matrix of hashes that are held at a time


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


class Hasher:
    """Polynomial hashes of substrings; powers are kept for the longest text so far."""

    def __init__(self):
        self.power, self.inverse = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.power) < n:
            size = len(self.power)
            for name, base in (("power", int(BASE)), ("inverse", _inverse(int(BASE)))):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, old * np.uint64(pow(base, size, 1 << 64))]))

    def kmers(self, words: list[bytes]) -> np.ndarray:
        """A hash per run of K words; one for the whole of a shorter text, none for an empty one."""
        if not words:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(b" ".join(words), np.uint8)
        self._grow(len(data) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * self.power[: len(data)], dtype=np.uint64)))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        k = min(K, len(words))
        start, end = starts[: len(words) - k + 1], ends[k - 1 :]
        h = (sums[end] - sums[start]) * self.inverse[start]
        h = (h ^ (h >> np.uint64(32))) * MIX
        return h ^ (h >> np.uint64(29))


def labelled(kmers: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, number of its occurrence): all different, up to collisions."""
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    place = np.arange(len(ranked))
    occurrence = np.empty(len(ranked), np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return (kmers + occurrence * BASE) * np.where(occurrence > 0, MIX, np.uint64(1))


def _band_keys(bands: int, kind: int) -> np.ndarray:
    return np.random.default_rng(SEED + kind).integers(1, 2**63, bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


KEYS = {False: _band_keys(BANDS, 0), True: _band_keys(SMALL_BANDS, 1)}


def _sketch(marks: np.ndarray, small: bool) -> np.ndarray:
    """A hash of each band's picked k-mers in text order."""
    keys, pick = KEYS[small], SMALL_PICK if small else PICK
    n, out = len(marks), np.empty(len(KEYS[small]), np.uint64)
    place = np.arange(n, dtype=np.uint64)
    wide = max(1, PART // max(1, n))
    for first in range(0, len(keys), wide):
        key = keys[first : first + wide, None]
        # 32 bits of hash above 32 bits of place: the smallest are picked, ties by place
        cells = ((marks[None, :] ^ (key >> np.uint64(7))) * key) & np.uint64(0xFFFFFFFF00000000) | place
        if n > pick:
            cells = np.partition(cells, pick - 1, axis=1)[:, :pick]
        at = np.sort(cells & np.uint64(0xFFFFFFFF), axis=1).astype(np.int64)
        h = np.zeros(len(at), np.uint64)
        for column in range(at.shape[1]):
            h = (h ^ marks[at[:, column]]) * MIX
            h ^= h >> np.uint64(31)
        out[first : first + wide] = (h ^ key[:, 0]) * BASE
    return out


def sketches(marks: np.ndarray) -> np.ndarray:
    """Buckets of a document: hashes of band and sketch.  None for a document of one k-mer or none: it has exact copies only."""
    out = []
    if 1 < len(marks) <= SMALL:
        out.append(_sketch(marks, True))
    if len(marks) >= LEAST * SMALL:
        out.append(_sketch(marks, False))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_key(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def similarity(a: list[bytes] | np.ndarray, b: list[bytes] | np.ndarray, hasher: Hasher | None = None) -> float:
    """Aligned labelled k-mers over all of both less the aligned; 0 if an alignment of LEAST is out of reach."""
    if isinstance(a, list):
        hasher = hasher or Hasher()
        a, b = labelled(hasher.kmers(a)), labelled(hasher.kmers(b))
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < LEAST * max(n, m):
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(at_a) < LEAST * (n + m - len(at_a)):
        return 0.0
    # an alignment of similarity LEAST leaves out (1 - LEAST) / (1 + LEAST) of both at most, and strays no further
    band = (1 - LEAST) / (1 + LEAST) * (n + m) + 1
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    tails: list[int] = []  # of the best increasing runs, by length
    for j in at_b[np.abs(at_a - at_b) <= band].tolist():
        i = bisect_left(tails, j)
        if i == len(tails):
            tails.append(j)
        else:
            tails[i] = j
    return len(tails) / (n + m - len(tails))


# Spark -----------------------------------------------------------------------------------------------------------------


def _keyed(with_sketches: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            keys, buckets, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                keys.append(word_key(words))
                if with_sketches:
                    found = sketches(labelled(hasher.kmers(words)))
                    buckets.append(found.view(np.int64))
                    sizes.append(len(found))
            if with_sketches:
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.int64), *buckets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=["key", "buckets"])
            else:
                rest = [c for c in batch.schema.names if c in ("doc_id", "text", "low", "high")]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *map(batch.column, rest)], names=["key", *rest])

    return run


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that are similar enough.  Pairs come sorted by the first of them, whose k-mers are kept meanwhile."""
    hasher, held, held_marks = Hasher(), None, None
    for batch in batches:
        left, right = [], []
        for a, b, text_a, text_b in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
            if a != held:
                held, held_marks = a, labelled(hasher.kmers(words_of(text_a)))
            if similarity(held_marks, labelled(hasher.kmers(words_of(text_b)))) >= LEAST:
                left.append(a)
                right.append(b)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _cross(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A link for each two components that are joined in a pair of blocks; rows come sorted by (centre, low, high)."""
    hasher = Hasher()

    def joined(group: list[tuple]) -> list[tuple[int, int]]:
        if len({comp for _, _, comp, _ in group}) == 1:
            return []
        marked = [(block, vertex, comp, labelled(hasher.kmers(words_of(text)))) for block, vertex, comp, text in group]
        low = min(block for block, *_ in marked)
        left = [m for m in marked if m[0] == low]
        right = [m for m in marked if m[0] != low] or left
        every = np.concatenate([m[3] for m in right])
        sizes = np.array([len(m[3]) for m in right])
        owner = np.repeat(np.arange(len(right)), sizes)
        order = np.argsort(every)
        every, owner = every[order], owner[order]
        found, done = [], set()
        for _, vertex, comp, marks in left:
            first, last = np.searchsorted(every, marks), np.searchsorted(every, marks, "right")
            many = last - first
            ends = np.cumsum(many)
            at = np.repeat(first - (ends - many), many) + np.arange(ends[-1])
            common = np.bincount(owner[at], minlength=len(right))
            for j in np.flatnonzero(common >= LEAST / (1 + LEAST) * (sizes + len(marks))).tolist():
                _, other, other_comp, other_marks = right[j]
                two = (min(comp, other_comp), max(comp, other_comp))
                if comp != other_comp and two not in done and similarity(marks, other_marks) >= LEAST:
                    done.add(two)
                    found.append((vertex, other))
        return found

    def batch_of(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

    key, group = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("centre", "low", "high", "block", "id", "comp", "text")), strict=True):
            if row[:3] != key:
                if links := joined(group) if group else []:
                    yield batch_of(links)
                key, group = row[:3], []
            group.append(row[3:])
    if links := joined(group) if group else []:
        yield batch_of(links)


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    met = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return keep(met.mapInArrow(_verified, "a long, b long"))


def components(links: DataFrame) -> DataFrame:
    """``id, comp`` of every vertex of ``links(a, b)``: comp is the smallest vertex of its connected component.

    Each round hangs every neighbour onto the smallest vertex nearby, first the larger ones, then the smaller ones; after
    a few rounds (logarithmic in the longest path) what is left is a star per component.
    """
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # done when every vertex has one link down, and none of these ends has a link further down
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("e"))
        ends = ends.groupBy("e.x").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("low"))
        if ends.where("ups > 1 or (ups = 1 and low = 0)").isEmpty():
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = keep(small.where("u != v").distinct())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("comp"))).distinct()


def vertex_classes(docs: DataFrame) -> DataFrame:
    """``key, comp`` of every distinct text of ``docs(text)``, told apart by its words."""
    sketched = docs.select("text").mapInArrow(_keyed(True), "key binary, buckets array<long>")
    distinct = sketched.groupBy("key").agg(F.first("buckets").alias("buckets"))
    vertices = keep(distinct.select("key", "buckets", F.monotonically_increasing_id().alias("id")))
    spread = vertices.select(F.explode("buckets").alias("bucket"), "id")
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keep(spread.join(shared, "bucket"))
    meets = members.groupBy("id").agg(F.sum("n").alias("meets"))
    members = members.select("bucket", "id").join(meets, "id")
    centres = members.groupBy("bucket").agg(F.max_by("id", F.struct("meets", "id")).alias("centre"))
    members = members.select("bucket", "id")
    names = vertices.select("key", "id")
    wanted = names.join(members.select("id").distinct(), "id")
    texts = docs.select("text").mapInArrow(_keyed(False), "key binary, text string")
    texts = keep(texts.join(wanted, "key").groupBy("id").agg(F.first("text").alias("text")))
    met = members.join(centres, "bucket").where("id != centre")
    pairs = keep(met.select(F.greatest("centre", "id").alias("a"), F.least("centre", "id").alias("b")).distinct())
    links = _links(pairs, texts)
    found = keep(components(links))

    # what the centre of a bucket has not joined: members of different components, among each other
    placed = members.join(found, "id", "left").select("bucket", "id", F.coalesce("comp", "id").alias("comp"))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    around = placed.join(mixed.select("bucket"), "bucket").join(centres, "bucket")
    around = keep(around.select("centre", "id", "comp").distinct())
    sizes = around.groupBy("centre").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = around.join(sizes.where("low != high").select("centre", blocks.alias("blocks")), "centre")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("centre", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "comp")
    dealt = dealt.join(texts, "id").repartition("centre", "low", "high").sortWithinPartitions("centre", "low", "high")
    more = keep(dealt.mapInArrow(_cross, "a long, b long"))
    found = keep(components(links.union(more)))
    return names.join(found, "id", "left").select("key", F.coalesce("comp", "id").alias("comp"))


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its class: ``doc_id, class_id, class_size``.

    class_id is the smallest doc_id of the class (null if it has none).  Texts with equal words are in one class; so are
    all null, empty and blank texts, which are like nothing else.  Rows that repeat are rows of the same class.  An empty table
    gives an empty result; further columns of ``docs`` are ignored.
    """
    rows = docs.select("doc_id", "text").mapInArrow(_keyed(False), "key binary, doc_id long, text string").select("doc_id", "key")
    placed = keep(rows.join(vertex_classes(docs), "key").select("doc_id", "comp"))
    sizes = placed.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return placed.join(sizes, "comp").select("doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every class: the one with the smallest doc_id, rows without one last; of those, by the hash of the row.

    Rows with equal doc_id in different classes all stay.  The choice does not depend on the order of the rows.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # hashes pass over nulls, so what is null is hashed too
    low, high = (F.xxhash64(F.lit(salt), F.struct(*columns), F.struct(*[c.isNull() for c in columns])) for salt in (1, 2))
    marked = docs.select("doc_id", "text", low.alias("low"), high.alias("high"), F.struct(*columns).alias("doc"))
    keyed = marked.select("doc_id", "text", "low", "high").mapInArrow(_keyed(False), "key binary, doc_id long, text string, low long, high long")
    rank = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "low", "high")
    firsts = keyed.groupBy("key").agg(F.min(rank).alias("first")).join(vertex_classes(docs), "key")
    chosen = firsts.groupBy("comp").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.low").alias("_low"), F.col("first.high").alias("_high"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("low") == F.col("_low")) & (F.col("high") == F.col("_high"))
    return marked.select("doc_id", "low", "high", "doc").join(chosen, same, "left_semi").dropDuplicates(["doc_id", "low", "high"]).select("doc.*")
