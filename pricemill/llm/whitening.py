"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The fit list X holds every distinct integer vector once, in blocks of rows spread over the cluster.  One pass over the
blocks per step gives both products: the left vectors are u_j = Xc w_j for centred rows Xc, and only the short w_j are
kept, so a pass takes X v - beta u of its rows, what it has in common with all earlier u (full reorthogonalisation on the
left) and its product with the transposed rows.  Right vectors are reorthogonalised against all earlier ones.  Where a
chain ends, because a direction has no deviation or eigenvalues coincide, it starts anew from a unit vector at right angles
to all earlier ones; after as many steps as dimensions the small bidiagonal matrix has the whole spectrum, and its SVD gives
components and deviations.

The driver holds vectors and matrices of the embeddings' dimension only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricemill.llm.common import keep

COMPONENTS = 4
SCALE = 256
BLOCK_ROWS = 8192
PARTITION_BYTES = 64 << 20  # of the fit list
RANK_TOLERANCE = 1e-12  # an eigenvalue below this share of the greatest one counts as zero
TWICE = 2  # passes of Gram-Schmidt
LONG = (1 << 63) - 1

Fit = tuple[np.ndarray, np.ndarray, list[int], int, float]


def quantised(embeddings: DataFrame, vector: str) -> DataFrame:
    """``x``: floor(256 c) of every entry, for rows whose vector has finite entries only."""
    usable = F.col(vector).isNotNull() & F.forall(
        F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.where(F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def _matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width).astype(dtype)
    out = np.zeros((len(lengths), width), dtype)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def fit_blocks(x: DataFrame, width: int, rows: int) -> DataFrame:
    """The distinct vectors of ``x``, which has ``rows`` rows, as blocks of rows, kept in the shared folder."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                rows = _matrix(batch.column(0).slice(start, BLOCK_ROWS), width)
                yield pa.RecordBatch.from_pydict({"data": [rows.tobytes()]}, schema=pa.schema([("data", pa.binary())]))

    parts = max(1, -(-rows * 8 * width // PARTITION_BYTES))
    return keep(x.select("x").distinct().coalesce(parts).mapInArrow(packed, "data binary"))


def _sums(blocks: DataFrame, of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all blocks of a short vector made from each block's rows."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(0):
                part = of(np.frombuffer(data.as_py(), np.int64).reshape(-1, width))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": np.arange(len(total), dtype=np.int32), "v": total})

    rows = blocks.mapInArrow(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row.i] = row.v
    return out


def exact_sums(blocks: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors of the fit list and the sum of every dimension, as integers of any size."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (width + 1)
        for batch in batches:
            for data in batch.column(0):
                rows = np.frombuffer(data.as_py(), np.int64).reshape(-1, width)
                small = not rows.size or max(int(rows.max()), -int(rows.min())) < LONG // len(rows)
                parts = rows.sum(axis=0).tolist() if small else rows.astype(object).sum(axis=0).tolist()
                totals = [a + b for a, b in zip(totals, [len(rows), *parts], strict=True)]
        yield pa.RecordBatch.from_pydict({"i": list(range(width + 1)), "v": [str(t) for t in totals]},
                                         schema=pa.schema([("i", pa.int32()), ("v", pa.string())]))

    rows = blocks.mapInArrow(partial, "i int, v string").groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    by = {r.i: int(r.v) for r in rows}
    return by.get(0, 0), [by.get(i + 1, 0) for i in range(width)]


def bidiagonalise(product: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors (rows) and the bidiagonal matrix of as many steps as there are dimensions.

    ``product(W, w)`` gives, for p = Xc w, the products of p with the left vectors Xc W, its squared norm and Xc^T p.
    """
    start = np.random.default_rng(width).standard_normal(width)
    right, left = np.zeros((0, width)), np.zeros((0, width))
    matrix, transposed = np.zeros((width, width)), np.zeros((0, width))
    v, beta, greatest = start / np.linalg.norm(start), 0.0, 0.0
    for j in range(width):
        right = np.vstack([right, v])
        w = v - beta * left[-1] if j and beta else v.copy()
        common, norm2, back = product(left, w)
        for again in range(TWICE):
            if again:
                common, norm2, back = product(left, w)
            w = w - common @ left
            norm2, back = max(0.0, norm2 - float(common @ common)), back - common @ transposed
            if not len(left) or float(common @ common) <= 1e-4 * norm2:
                break
        alpha = float(np.sqrt(norm2))
        greatest = max(greatest, alpha)
        if alpha <= 1e-14 * greatest or not alpha:
            # Xc v lies in the span of the earlier left vectors: no new one, and the chain ends
            alpha, residual = 0.0, np.zeros(width)
            left, transposed = np.vstack([left, np.zeros(width)]), np.vstack([transposed, np.zeros(width)])
        else:
            left, transposed = np.vstack([left, w / alpha]), np.vstack([transposed, back / alpha])
            residual = transposed[-1] - alpha * v
        matrix[j, j] = alpha
        if j + 1 == width:
            break
        for _ in range(TWICE):
            residual = residual - right.T @ (right @ residual)
        beta = float(np.linalg.norm(residual))
        if beta <= 1e-13 * greatest or not beta:
            beta, residual = 0.0, np.random.default_rng(width + j + 1).standard_normal(width)
            for _ in range(TWICE + 1):
                residual = residual - right.T @ (right @ residual)
                residual /= np.linalg.norm(residual)
            v = residual
        else:
            v = residual / beta
        matrix[j, j + 1] = beta
    return right, matrix


def fit(blocks: DataFrame, width: int, components: int = COMPONENTS) -> Fit:
    """Components (rows), their eigenvalues, the sums, the number of vectors and the trace of the covariance."""
    n, sums = exact_sums(blocks, width)
    mean = np.array([s / n for s in sums]) if n else np.zeros(width)

    def product(left: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        known = len(left)

        def of(rows: np.ndarray) -> np.ndarray:
            centred = rows - mean
            p = centred @ w
            return np.concatenate([(centred @ left.T).T @ p if known else np.zeros(0), [p @ p], p @ centred])

        out = _sums(blocks, of, width)
        return out[:known], float(out[known]), out[known + 1 :]

    if not n or not width:
        return np.zeros((0, width)), np.zeros(0), sums, n, 0.0
    right, matrix = bidiagonalise(product, width)
    _, deviations, turned = np.linalg.svd(matrix)
    values = deviations**2 / n
    count = min(components, int((values > RANK_TOLERANCE * values[0]).sum()) if values[0] > 0 else 0)
    return turned[:count] @ right, values[:count], sums, n, float(values.sum())


def whitened(rows: np.ndarray, mean: np.ndarray, vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return (rows - mean) @ vectors.T / np.sqrt(values)


def identity_error(blocks: DataFrame, model: Fit, width: int) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    vectors, values, sums, n, _ = model
    mean, k = np.array([s / n for s in sums]), len(values)

    def of(rows: np.ndarray) -> np.ndarray:
        white = whitened(rows, mean, vectors, values)
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    out = _sums(blocks, of, width)
    centre = out[:k] / n
    return float(np.abs(out[k:].reshape(k, k) / n - np.outer(centre, centre) - np.eye(k)).max())


def deviations(rows: np.ndarray, sums: list[int], n: int) -> list[int | None]:
    """The exact sum of (n x - S)^2 of every row; null where a long cannot hold it."""
    most = max([abs(s) for s in sums] + [n * max(int(rows.max()), -int(rows.min()))]) if rows.size else 0
    if most < LONG // 2 and (2 * most) ** 2 * rows.shape[1] < LONG:
        return ((n * rows - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in rows.tolist()]
    return [d if d <= LONG else None for d in exact]


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per row of ``embeddings(vec_id, embedding)`` and component: the whitened coordinate and what the component explains.

    Rows whose vector is null or holds null or non-finite entries are dropped.  A vector shorter than the longest one counts
    as padded with zeros.  Repeated vectors count once in the fit and have a result per row; null and repeated vec_ids are
    rows like others.  Components without any deviation (below 1e-12 of the greatest eigenvalue) are left out, so an empty table,
    one distinct vector or vectors without entries give an empty result; equal eigenvalues give orthogonal components in an
    order that a rerun repeats.  ``deviation`` is null where a long cannot hold it.  Further columns are ignored.
    """
    x = quantised(embeddings.select("vec_id", vector), vector)
    found = x.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
    width = found[0] or 0
    schema = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double".format(
        embeddings.schema["vec_id"].dataType.simpleString())
    if not width:
        return embeddings.sparkSession.createDataFrame([], schema)
    blocks = fit_blocks(x, width, found[1])
    model = fit(blocks, width, components)
    vectors, values, sums, n, trace = model
    if not len(values):
        return embeddings.sparkSession.createDataFrame([], schema)
    error, mean, k = identity_error(blocks, model, width), np.array([s / n for s in sums]), len(values)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                piece = batch.slice(start, BLOCK_ROWS)
                rows = _matrix(piece.column(1), width)
                many = len(rows) * k
                yield pa.RecordBatch.from_arrays([
                    piece.column(0).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(many, n, np.int64)),
                    pa.array([d for d in deviations(rows, sums, n) for _ in range(k)], pa.int64()),
                    pa.array(whitened(rows, mean, vectors, values).ravel()),
                    pa.array(np.tile(values / trace, len(rows))), pa.array(np.full(many, error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(of, schema)
