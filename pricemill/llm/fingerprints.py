"""Homomorphic multiset hash of a document's paragraphs, and its likeness.

A text is the multiset of its lines.  Every line is hashed to a wide vector; the fingerprint is the sum of the vectors,
lane by lane, modulo a power of two.  So it does not depend on the order of the lines, and lines can be inserted or
deleted without the rest of the text (``insert``, ``delete``).  A line's vector has two parts:

* ``EXACT`` lanes modulo 2^16, uniformly hashed from the whole line: equal fingerprints mean equal multisets of lines;
* ``LIKE`` lanes modulo 2^32: each window of ``WINDOW`` bytes of the line, and the line itself, adds +1 or -1 to one
  lane; so does each window of ``SMALL`` bytes of a line of fewer than ``SHORT`` bytes, which has few others.  The inner product of two such sums estimates the inner product of the window counts, so their cosine
  estimates the share of common text.  The error is about 1 / sqrt(LIKE).

The fingerprint is the base64 of all lanes, little-endian.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

EXACT = 32
LIKE = 256
WINDOW = 16
SMALL, SHORT = 4, 48
ROWS_PER_RANGE = 4000
MOST_RANGES = 10_000  # the driver holds a row for each; a larger table has longer ranges, read as streams
MIXERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
BLOCK = 1 << 20  # bytes of a long text handled at a time


def _window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the windows of SMALL or WINDOW bytes that do not hold a line feed."""
    x = data.astype(np.uint64)
    for width in (1, 2, 4)[: 2 if size == SMALL else 3]:
        x = x[:-width] | (x[width:] << np.uint64(8 * width))
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    whole = lines[size:] == lines[:-size]
    h = x * MIXERS[0] if size == SMALL else (x[: -WINDOW // 2] * MIXERS[0]) ^ ((x[WINDOW // 2 :] * MIXERS[1]) >> np.uint64(7))
    h = (h ^ (h >> np.uint64(32))) * MIXERS[2]
    return h[whole]


def _signed(hashes: np.ndarray) -> np.ndarray:
    counts = np.bincount((hashes >> np.uint64(55)).astype(np.int64), minlength=2 * LIKE)
    return counts[0::2] - counts[1::2]


class Fingerprint:
    """The lanes of a multiset of lines."""

    def __init__(self, exact: np.ndarray | None = None, like: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint16) if exact is None else exact
        self.like = np.zeros(LIKE, np.uint32) if like is None else like

    @classmethod
    def of(cls, text: str | None) -> Fingerprint:
        """Of a whole text; null and empty texts are the empty multiset."""
        if not text:
            return cls()
        data = text.encode("utf-8", "surrogatepass")
        lines = data.split(b"\n")
        digests = np.frombuffer(
            b"".join(hashlib.blake2b(line, digest_size=2 * EXACT).digest() for line in lines), "<u2").reshape(-1, EXACT)
        like = _signed(digests[:, :4].copy().view("<u8").ravel())
        short = b"\n".join(line for line in lines if len(line) < SHORT)
        for size, part in ((WINDOW, data), (SMALL, short)):
            values = np.frombuffer(part, np.uint8)
            for start in range(0, max(0, len(values) - size + 1), BLOCK):
                like += _signed(_window_hashes(values[start : start + BLOCK + size - 1], size))
        return cls(digests.sum(0, dtype=np.uint64).astype(np.uint16), like.astype(np.uint32))

    def insert(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.like + other.like)

    def delete(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.like - other.like)

    def likeness(self, other: Fingerprint) -> float:
        """0 to 1; 1 for equal fingerprints, 0 if just one of them is empty."""
        if np.array_equal(self.exact, other.exact) and np.array_equal(self.like, other.like):
            return 1.0
        a, b = self.like.astype(np.int32).astype(np.float64), other.like.astype(np.int32).astype(np.float64)
        norm = float(np.sqrt((a @ a) * (b @ b)))
        return min(1.0, max(0.0, float(a @ b) / norm)) if norm else 0.0

    def text(self) -> str:
        return base64.b64encode(self.exact.astype("<u2").tobytes() + self.like.astype("<u4").tobytes()).decode()


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down, in code points) replaced by as many of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order; the row after a document is its next one.  A row marked as tail ends a range."""
    held = None  # (doc_id, text, fingerprint)
    for batch in batches:
        rows = []
        for doc_id, text, tail in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "tail")), strict=True):
            text = text or ""
            mark = Fingerprint.of(text)
            if held:
                before_id, before, before_mark = held
                changed = edited(before, text)
                changed_mark = before_mark if changed == before else Fingerprint.of(changed)
                rows.append((
                    before_id, len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    before_mark.text(), changed_mark.text(), before_mark.likeness(changed_mark), before_mark.likeness(mark),
                ))
            held = None if tail else (doc_id, text, mark)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs(doc_id, text)``, of its edited text, and likeness to that and the next one.

    Next is by ascending doc_id, null first, ties by the text's hash; after the last comes the first, so a single document
    is its own next one.  A null text counts as empty; the likeness of two empty texts is 1, of an empty and another
    one 0.  An empty table gives an empty result; further columns of ``docs`` are ignored.

    The rows are dealt out by ranges of doc_id, and every range also gets the first row of the next one, so texts are
    shuffled once and no task sees more than its range, a batch at a time.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    rows = docs.count()
    if not rows:
        return spark.createDataFrame([], SCHEMA)
    ranges = min(MOST_RANGES, -(-rows // ROWS_PER_RANGE))
    steps = [i / ranges for i in range(1, ranges)]
    bounds = docs.agg(F.percentile_approx(key, steps, 100 * ranges)).first()[0] if steps else []
    bounds = sorted({int(b) for b in bounds})

    @F.pandas_udf("int")
    def range_of(ids):
        import pandas as pd

        return pd.Series(np.searchsorted(np.array(bounds, np.int64), ids.to_numpy(np.int64), side="left"))

    # the ranges in use and the first row of each: as many small rows as there are ranges
    order = F.struct(key, F.coalesce(F.xxhash64("text"), F.lit(0)))
    firsts = docs.groupBy(range_of(key).alias("range")).agg(F.min(order).alias("first")).orderBy("range").collect()
    used = [r["range"] for r in firsts]
    before = [(tuple(r["first"]), used[i - 1]) for i, r in enumerate(firsts)]
    near = spark.createDataFrame([(f[0], f[1], to) for f, to in before], "id long, hash long, to int")
    near = near.groupBy("id", "hash").agg(F.min("to").alias("to"))
    main = docs.select("doc_id", "text", range_of(key).alias("range"), F.lit(False).alias("tail"))
    hashed = docs.select("doc_id", "text", key.alias("id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("hash"))
    # one row per range: its first row, as the tail of the range before
    tails = hashed.join(F.broadcast(near), ["id", "hash"]).groupBy("to").agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    tails = tails.select("doc_id", "text", F.col("to").alias("range"), F.lit(True).alias("tail"))
    dealt = main.unionByName(tails).repartition(len(used), "range").sortWithinPartitions(
        "range", "tail", key, F.coalesce(F.xxhash64("text"), F.lit(0)))
    return dealt.mapInArrow(_compare, SCHEMA)
