"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the n-grams of ``GRAMS`` characters of the lower-cased text, hashed to ``BUCKETS`` buckets, weighted by
(1 + log count) * log(documents / documents with it), scaled to length 1.  Document frequencies are counted over all
training documents.  The weights are fitted by follow-the-regularised-leader (per-coordinate rates, elastic-net penalty:
L1 makes them sparse) on a sample of at most ``SAMPLE`` documents, in equal parts per language.  A fifth of the sample
is left out of the fit; on it the temperature that divides the scores is chosen by likelihood.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
SAMPLE = 2000  # labelled documents that the weights are fitted on, at most
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
CALIBRATION = 5  # each 5th document of the sample is for the temperature
UNKNOWN = "und"
PART = 1 << 18  # characters of a text handled at a time
MIXERS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def counts(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text."""
    out = np.zeros(BUCKETS, np.int64)
    longest = max(GRAMS)
    lowered = text.lower()
    for start in range(0, len(lowered), PART):
        part = lowered[start : start + PART + longest - 1]
        units = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        h = np.zeros(len(units), np.uint64)
        for n in range(1, longest + 1):
            if len(units) < n:
                break
            h = h[: len(units) - n + 1] + units[n - 1 :] * MIXERS[n - 1]
            if n in GRAMS:
                mine = h[: min(len(h), PART)] if start + PART < len(lowered) else h
                mixed = (mine ^ (mine >> np.uint64(31))) * MIXERS[n % len(MIXERS)]
                out += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return out


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # BUCKETS
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return scaled(counts(text), self.idf)

    def logits(self, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its calibrated probability; (und, 0) without letters, or without any training document."""
        if not self.languages or not has_letters(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*self.features(text)) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def scaled(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(count)
    return at, scaled_at(at, count[at], idf)


def scaled_at(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(count)) * idf[at]
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


class Sample:
    """The vectors of the sample, each made from its counts when it is asked for: the driver holds the counts only."""

    def __init__(self, at: pa.ChunkedArray, count: pa.ChunkedArray, idf: np.ndarray, chosen: np.ndarray):
        self.at, self.count, self.idf, self.chosen = at, count, idf, chosen

    def __len__(self) -> int:
        return len(self.chosen)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        row = int(self.chosen[i])
        at = self.at[row].values.to_numpy()
        return at, scaled_at(at, self.count[row].values.to_numpy().astype(np.int64), self.idf)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit(rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; the last coordinate is the bias, which has no penalty."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    one_hot = np.eye(classes)

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(z[at]) <= L1] = 0
        w[-1] = -z[BUCKETS] / ((BETA + np.sqrt(n[BUCKETS])) / ALPHA)
        return w

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            g = x[:, None] * (softmax(x @ w) - one_hot[labels[i]])
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(BUCKETS + 1))
    return w[:-1].astype(np.float32), w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the largest likelihood, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    # labels are softened by one error in as many documents, or a sample without errors would ask for temperature 0
    wrong = 1 / (len(labels) + 2)
    want = np.full(logits.shape, wrong / max(1, logits.shape[1] - 1))
    want[np.arange(len(labels)), labels] = 1 - wrong

    def loss(log_t: float) -> float:
        s = logits / np.exp(log_t)
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - (want * s).sum(1)))

    low, high, golden = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            df += counts(text or "") > 0
            rows += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], rows), pa.int64())], names=["bucket", "docs"])


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            count = counts(text or "")
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([count[at].astype(np.int32)], pa.list_(pa.int32()))], names=["lang", "at", "count"])


def train(docs: DataFrame) -> Model:
    """A model from the rows of ``docs(doc_id, text, lang)`` that have a lang; an empty model if there is none.

    The driver receives the document frequencies (a number per bucket) and the n-gram counts of the sample.
    """
    labelled = docs.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    frequency = dict(map(tuple, labelled.select("text").mapInArrow(_document_frequencies, "bucket int, docs long")
                         .groupBy("bucket").agg(F.sum("docs")).collect()))
    total = frequency.pop(-1, 0)
    if not total:
        return Model([], np.ones(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    idf = np.log((1.0 + total) / (1.0 + np.bincount(list(frequency), list(frequency.values()), BUCKETS))) + 0.05
    classes = labelled.select("lang").distinct().count()
    share = max(1, SAMPLE // classes)
    # the sample: the first of each language by the hash of doc_id; Spark keeps `share` rows a task before it shuffles
    order = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("doc_id")), "doc_id")
    picked = labelled.select("lang", "doc_id").withColumn("n", F.row_number().over(order)).where(F.col("n") <= share)
    picked = picked.orderBy("n", "lang").limit(SAMPLE).select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id")).distinct()
    chosen = labelled.join(F.broadcast(picked), (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    rows = chosen.orderBy(F.xxhash64(F.col("doc_id")), "doc_id", F.xxhash64("text")).limit(SAMPLE).select("text", "lang").mapInArrow(
        _counted, "lang string, at array<int>, count array<int>").toArrow()
    named = rows["lang"].to_pylist()
    languages = sorted(set(named))
    labels = np.array([languages.index(name) for name in named])
    aside = np.arange(len(labels)) % CALIBRATION == CALIBRATION - 1
    use, checked = np.flatnonzero(~aside), np.flatnonzero(aside)
    weights, bias = fit(Sample(rows["at"], rows["count"], idf, use), labels[use], len(languages))
    model = Model(languages, idf, weights, bias)
    left = Sample(rows["at"], rows["count"], idf, checked)
    model.temperature = calibrate(np.array([model.logits(*left[i]) for i in range(len(left))]), labels[checked])
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced."""
    kept = docs.drop("lang_pred", "score")
    # plain arrays, BUCKETS x languages numbers
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.idf, model.weights, model.bias, model.temperature))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts):
        import pandas as pd

        model = Model(*shared.value)
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return kept.withColumn("_predicted", predicted("text")).select(
        *[F.col(f"`{c}`") for c in kept.columns], "_predicted.lang_pred", "_predicted.score")


def held_out():
    """Documents that no model learns from: CRC-32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame) -> DataFrame:
    """Every row of ``docs(doc_id, text, lang)`` with the language predicted from its whole text.

    Learns from the rows with a lang that are not held out (a null doc_id is not).  A null text, or one without
    letters, is ``und`` with score 0, as is every text when there is nothing to learn from.  Repeated rows are predicted
    alike; an empty table gives an empty result; further columns of ``docs`` are ignored.
    """
    rows = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(rows.where(~F.col("held_out")))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


LEAST_SCORE = 0.3


def known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose predicted language has a score of LEAST_SCORE at least, with their own columns.

    Rows with a null or empty text, or one without letters, go; whole texts count, however long.  Repeated rows stay or go
    alike, and keep their number; ties between languages go to the first by name.  Rows without a lang are predicted, but not learned
    from; a table without any lang, or without rows, gives an empty result.
    """
    model = train(docs)
    shape = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    marked = predict(docs.select(*shape, F.col("text")), model)
    kept = marked.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
