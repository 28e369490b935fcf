"""Language-model scores of documents by context-tree weighting over bytes, beside a word unigram score.

A text is scored as the bytes of its words, A-Z in lower case, joined by one space and closed by a zero byte.  Each byte
is eight binary decisions; the node reached by the bits so far has a context tree over the bytes before.  A tree node
estimates its bit by Krichevsky-Trofimov (counts + 1/2), and mixes: P_w = P_kt / 2 + (product of P_w of its children) / 2.
The counts of the training texts fix the weights; a byte's probability is the mixture along its context, over all depths
from none to ``DEPTH`` bytes.

The tree has every context of the training texts, however rare.  It is a table of the distinct runs of DEPTH + 1 bytes
(codes) with their probabilities, which grows with the corpus and stays distributed; a context that only other texts
have counts nothing there, and predicts 1/2 at each node.  Every byte of every text is scored: the HOT codes seen most
often are sent to all tasks, the others meet the table in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pricemill.llm.common import keep

DEPTH = 5
TOP = 2  # the driver joins the subtrees at this depth
SUFFIX = (1 << 8 * (TOP + 1)) - 1
HOT = 1 << 21  # codes that are sent to all tasks, at most
SLICE = 1 << 19  # codes whose subtrees are handled together
HEAVY = 1 << 20  # words with a share of 1 / HEAVY of all tokens are sent to all tasks: HEAVY words at most
BATCH = 2 << 20  # bytes handled at a time
GATHER = 1_000_000  # distinct runs of bytes that a task gathers before it sends them on
WORDS = 300_000  # the same for words
HALF = math.log(2.0)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def codes_of(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """DEPTH bytes and the next one, for each byte of all streams (oldest byte lowest), and where each stream begins."""
    data = np.frombuffer(b"".join(bytes(DEPTH) + s for s in streams), np.uint8).astype(np.uint64)
    codes = np.zeros(len(data) - DEPTH, np.uint64)
    for j in range(DEPTH + 1):
        codes |= data[j : j + len(codes)] << np.uint64(8 * j)
    sizes = np.fromiter(map(len, streams), np.int64, len(streams))
    begins = np.cumsum(sizes) - sizes
    # between two streams there are DEPTH codes whose last byte is padding
    real = np.ones(len(codes), bool)
    for j in range(DEPTH):
        real[(np.cumsum(sizes + DEPTH) - DEPTH)[:-1] + j] = False
    return codes[real], begins


def parts_of(streams: Iterable[tuple[object, bytes]]) -> Iterator[list[tuple[object, bytes]]]:
    """Lists of about BATCH bytes."""
    some, size = [], 0
    for item in streams:
        some.append(item)
        size += len(item[1])
        if size >= BATCH:
            yield some
            some, size = [], 0
    if some:
        yield some


# model -----------------------------------------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 1/2, by Stirling's series on x + 8."""
    out, y = np.zeros_like(x), x.copy()
    for _ in range(8):
        out -= np.log(y)
        y += 1.0
    r = 1.0 / (y * y)
    return out + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y


SMALL = {x: _log_gamma(np.arange(4096) + x) for x in (0.5, 1.0)}


def _log_gamma_from(n: np.ndarray, x: float) -> np.ndarray:
    """Log gamma of n + x; most counts are small and looked up."""
    out = SMALL[x][np.minimum(n, 4095)]
    large = np.flatnonzero(n > 4095)
    out[large] = _log_gamma(n[large] + x)
    return out


def _parent(key: np.ndarray, level: int) -> np.ndarray:
    """The node of the context that is one byte shorter; a node is context << level | the ``level`` bits so far."""
    return key >> level + 8 << level | key & (1 << level) - 1


def _up(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray | None, level: int, depths: Iterable[int]) -> list[tuple]:
    """The nodes of one decision at each of ``depths``, deepest first, from rows that belong to nodes of the deepest.

    Per depth: the nodes, where each row or deeper node has its own among them, the weight of the node's estimate, the
    estimate of a one, and log P_w.  ``split``: log P_w of the rows, where these are nodes one deeper.
    """
    nodes = []
    for d in depths:
        key, at = np.unique(key, return_inverse=True)
        zeros, ones = (np.bincount(at, n, len(key)).astype(np.int64) for n in (zeros, ones))
        weighted = _log_gamma_from(zeros, 0.5) + _log_gamma_from(ones, 0.5) - _log_gamma_from(zeros + ones, 1.0) - math.log(math.pi)
        weight = np.ones(len(key))
        if d < DEPTH:
            own = weighted
            weighted = np.logaddexp(own, np.bincount(at, split, len(key))) - HALF
            weight = np.exp(np.minimum(0.0, own - HALF - weighted))
        nodes.append((key, at, weight, (ones + 0.5) / (zeros + ones + 1.0), weighted))
        key, split = _parent(key, level), weighted
    return nodes


def _down(nodes: list[tuple], said: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixed estimate of a one, and weight left, for the rows that ``nodes`` came from; given both above the shallowest nodes."""
    for _, at, weight, estimate, _ in reversed(nodes):
        said, left = (said + left * weight * estimate)[at], (left * (1 - weight))[at]
    return said, left


def _rows(codes: np.ndarray, n: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Node at DEPTH, zeros, ones and the bit of each code at one decision."""
    byte = codes >> 8 * DEPTH
    bit = byte >> 7 - level & 1
    return (codes & (1 << 8 * DEPTH) - 1) << level | byte >> 8 - level, n * (1 - bit), n * bit, bit


def _subtrees(codes: np.ndarray, n: np.ndarray) -> Iterator[tuple]:
    """Per decision, the rows' sums by node at depth TOP: level, node, zeros, ones, log P_w of all nodes below it."""
    for level in range(8):
        key, zeros, ones, _ = _rows(codes, n, level)
        below = _up(key, zeros, ones, None, level, range(DEPTH, TOP, -1))
        above, at = np.unique(_parent(below[-1][0], level), return_inverse=True)
        split = np.bincount(at, below[-1][4], len(above))
        for _, place, *_ in reversed(below):
            at = at[place]
        zeros, ones = (np.bincount(at, c, len(above)).astype(np.int64) for c in (zeros, ones))
        yield level, above, zeros, ones, split


def _tops(level: int, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted nodes at depth TOP, with the mixed estimate and the weight left after the depths 0 .. TOP."""
    nodes = _up(key, zeros, ones, split, level, range(TOP, -1, -1))
    said, left = _down(nodes, np.zeros(len(nodes[-1][0])), np.ones(len(nodes[-1][0])))
    order = np.argsort(key)
    return key[order], said[order], left[order]


def _log_probabilities(codes: np.ndarray, n: np.ndarray, tops: list[tuple]) -> np.ndarray:
    """Natural logarithm of each code's last byte given the bytes before it; all codes below a node at depth TOP + 1 are there."""
    out = np.zeros(len(codes))
    for level, (top, said, left) in enumerate(tops):
        key, zeros, ones, bit = _rows(codes, n, level)
        nodes = _up(key, zeros, ones, None, level, range(DEPTH, TOP, -1))
        at = np.searchsorted(top, _parent(nodes[-1][0], level))
        one, _ = _down(nodes, said[at], left[at])
        out += np.log(np.where(bit, one, 1 - one))
    return out


class Model:
    """The tree in one process, from the codes that were learnt and their counts."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.codes, self.n = codes, n

    @classmethod
    def of(cls, levels: list[tuple[np.ndarray, np.ndarray]]) -> Model:
        """``levels``: per depth the sorted contexts and their counts of 256 next bytes; the deepest has all that was learnt."""
        contexts, counts = levels[DEPTH]
        at, byte = np.nonzero(counts)
        return cls(contexts[at].astype(np.int64) | byte.astype(np.int64) << 8 * DEPTH, counts[at, byte].astype(np.int64))

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Natural logarithm of each code's last byte given the bytes before it."""
        every, at = np.unique(np.concatenate([self.codes, codes.astype(np.int64)]), return_inverse=True)
        n = np.bincount(at[: len(self.codes)], self.n, len(every)).astype(np.int64)
        tops = [_tops(*rows) for rows in _subtrees(every, n)]
        return _log_probabilities(every, n, tops)[at[len(self.codes) :]]


# Spark -----------------------------------------------------------------------------------------------------------------


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of bytes, how often training texts have them, and how often all texts do."""
    held: list[pa.Table] = []

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("code").aggregate([("n", "sum"), ("seen", "sum")]).rename_columns(["code", "n", "seen"])

    texts = ((h, b" ".join(words_of(t)) + b"\0") for b in batches for t, h in zip(*(b.column(c).to_pylist() for c in ("text", "held_out")), strict=True))
    for part in parts_of(texts):
        codes, _ = codes_of([s for _, s in part])
        learnt = np.repeat([not h for h, _ in part], [len(s) for _, s in part])
        encoded = pa.array(codes.view(np.int64)).dictionary_encode()
        at, size = encoded.indices.to_numpy(), len(encoded.dictionary)
        held.append(pa.table({"code": encoded.dictionary, "n": np.bincount(at[learnt], minlength=size), "seen": np.bincount(at, minlength=size)}))
        if sum(map(len, held)) > GATHER:
            held[:] = [summed()]
            if len(held[0]) > GATHER:
                yield from held[0].to_batches()
                held.clear()
    if held:
        yield from summed().to_batches()


def _word_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's words; the end token, which no word equals, is the empty word."""
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            counts.update(words_of(text))
            counts[b""] += 1
            if len(counts) > WORDS:
                yield rows()
                counts = Counter()
    if counts:
        yield rows()


def _whole_subtrees(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """``code, n, seen`` of about SLICE codes at a time, all codes of a context of TOP + 1 bytes together; rows come sorted by it."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        held.append([batch.column(c).to_numpy() for c in ("code", "n", "seen")])
        if sum(len(h[0]) for h in held) >= SLICE:
            code, n, seen = map(np.concatenate, zip(*held, strict=True))
            suffix = code >> 8 * (DEPTH - TOP - 1) & SUFFIX
            last = int(np.argmax(suffix == suffix[-1]))
            if last:
                yield code[:last], n[:last], seen[:last]
            held = [[code[last:], n[last:], seen[last:]]]
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for code, n, _ in _whole_subtrees(batches):
        for level, *columns in _subtrees(code, n):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), level)), *map(pa.array, columns)], names=["level", "node", "zeros", "ones", "split"])


def code_table(texts: DataFrame) -> DataFrame:
    """``code, log_p, seen`` of every run of DEPTH + 1 bytes in ``texts(text, held_out)``: the natural logarithm of its last byte's
    probability after those before, learnt from the rows that are not held out, and how often all rows have it.

    All nodes of the tree count.  The codes are dealt by the last TOP + 1 bytes of their context, so a task has whole
    subtrees; it goes up them twice, first to sum log P_w by node at depth TOP, then to mix what comes down to it.  Between,
    the driver works on the depths 0 .. TOP: 256 ** TOP contexts at most.
    """
    spark = texts.sparkSession
    grams = texts.select("text", "held_out").mapInArrow(_gram_counts, "code long, n long, seen long")
    grams = grams.groupBy("code").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    suffix = F.shiftrightunsigned("code", 8 * (DEPTH - TOP - 1)).bitwiseAND(SUFFIX)
    dealt = keep(grams.withColumn("suffix", suffix).repartition("suffix").sortWithinPartitions("suffix"))
    sums = dealt.mapInArrow(_sums, "level long, node long, zeros long, ones long, split double")
    sums = sums.groupBy("level", "node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "split")]).toArrow()
    level, *columns = (sums[c].to_numpy() for c in ("level", "node", "zeros", "ones", "split"))
    tops = spark.sparkContext.broadcast([_tops(d, *(c[level == d] for c in columns)) for d in range(8)] if len(level) else [])

    def probabilities(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, n, seen in _whole_subtrees(batches):
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(_log_probabilities(code, n, tops.value)), pa.array(seen)], names=["code", "log_p", "seen"])

    return keep(dealt.mapInArrow(probabilities, "code long, log_p double, seen long"))


def most_seen(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The codes of ``table`` that are seen most often, HOT at most, sorted, and their ``log_p``: all with counts in the upper classes."""
    kind = F.floor(8 * F.log2("seen")).cast("long")
    least, held = None, 0
    for k, n in sorted(map(tuple, table.groupBy(kind.alias("kind")).agg(F.count(F.lit(1))).collect()), reverse=True):
        held += n
        if held > HOT:
            break
        least = k
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0)
    found = table.where(kind >= least).select("code", "log_p").toArrow()
    code = found["code"].to_numpy()
    order = np.argsort(code)
    return code[order], found["log_p"].to_numpy()[order]


SCHEMA = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word: binary, n: long>>, missed array<long>"
)


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of every whole text of ``docs(doc_id, text)``; learns from those whose CRC-32 of doc_id, modulo 5, is not 1.

    A null or empty text is the end token alone; a null doc_id is not held out.  With nothing to learn from, every byte has
    probability 1/256 and the base scores are 0.  Repeated rows are scored alike; an empty table gives an empty result;
    further columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    training = rows.where(~F.col("held_out")).select("text")
    table = code_table(rows)
    hot = spark.sparkContext.broadcast(most_seen(table))

    words = training.mapInArrow(_word_counts, "word binary, n long")
    words = keep(words.groupBy("word").agg(F.sum("n").alias("n")))
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # at most HEAVY words; the end token is one of them
    often = words.where((F.col("n") * HEAVY >= total) | (F.length("word") == 0)).toArrow()
    heavy = spark.sparkContext.broadcast(dict(zip(often["word"].to_pylist(), often["n"].to_pylist(), strict=True)))
    smoothed = total + 0.5 * (distinct + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_codes, hot_logs = hot.value
        known = {w: (n, math.log10((n + 0.5) / smoothed)) for w, n in heavy.value.items()}
        end = known.get(b"", (0, math.log10(0.5 / smoothed)))

        def streams():
            for batch in batches:
                for row, doc_id, held, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "held_out", "text")), strict=True):
                    tokens = words_of(text)
                    base, seen, rare = end[1], int(end[0] > 0), []
                    for word, n in Counter(tokens).items():
                        entry = known.get(word)
                        if entry:
                            base += n * entry[1]
                            seen += n
                        else:
                            rare.append((word, n))
                    yield (row, doc_id, held, len(tokens) + 1, seen, base, rare), b" ".join(tokens) + b"\0"

        for part in parts_of(streams()):
            texts = [s for _, s in part]
            codes, begins = codes_of(texts)
            encoded = pa.array(codes.view(np.int64)).dictionary_encode()
            distinct, place = encoded.dictionary.to_numpy(), encoded.indices.to_numpy()
            at = np.minimum(np.searchsorted(hot_codes, distinct), max(0, len(hot_codes) - 1))
            hit = hot_codes[at] == distinct if len(hot_codes) else np.zeros(len(distinct), bool)
            logs = np.zeros(len(distinct))
            logs[hit] = hot_logs[at[hit]]
            scores = np.add.reduceat(logs[place], begins) / math.log(10)
            open_ = np.flatnonzero(~hit[place])
            missed = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(open_, np.append(begins, len(codes))).astype(np.int32)), pa.array(distinct[place[open_]]))
            row, doc_id, held, n, seen, base, rare = zip(*(r for r, _ in part), strict=True)
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in rare]))).astype(np.int32)
            pairs = pa.StructArray.from_arrays(
                [pa.array([w for r in rare for w, _ in r], pa.binary()), pa.array([k for r in rare for _, k in r], pa.int64())], ["word", "n"])
            yield pa.RecordBatch.from_arrays([
                pa.array(row, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(held), pa.array(n, pa.int64()),
                pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(scores),
                pa.ListArray.from_arrays(pa.array(offsets), pairs), missed,
            ], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "missed"])

    scored = keep(rows.select(F.monotonically_increasing_id().alias("row"), "*").mapInArrow(run, SCHEMA))
    # the rest of the base score: rare words meet their counts
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
    counted = rare.join(words.select("word", F.col("n").alias("c")), "word", "left").select(
        "row", "times", F.coalesce("c", F.lit(0)).alias("c"))
    added = counted.groupBy("row").agg(
        F.sum(F.col("times") * F.log10((F.col("c") + 0.5) / F.lit(smoothed))).alias("more"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"))
    # and the rest of the score: codes that are not sent to the tasks meet the table
    missed = scored.select("row", F.explode("missed").alias("code")).groupBy("row", "code").agg(F.count(F.lit(1)).alias("times"))
    met = missed.join(table.select("code", "log_p"), "code").groupBy("row").agg((F.sum(F.col("times") * F.col("log_p")) / math.log(10)).alias("further"))
    return scored.join(added, "row", "left").join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("further", F.lit(0.0))).alias("score"))
