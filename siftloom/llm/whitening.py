"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A are never factorised in one place. A pass over the rows adds up a Gram matrix per task; its Cholesky
factor R1, taken with a shift that keeps it positive definite, turns the rows into better conditioned ones by a
triangular solve, Q1 = A / R1. The next pass forms the Gram matrix of Q1, and so on until the columns are orthonormal.
The product R = Rk ... R1 has A = Q R, so its singular values and right singular vectors are those of A, to double
precision, which the Gram matrix of A itself would only give to half of that.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftloom.llm.store import map_arrow, stored
from siftloom.llm.vectors import dimension, matrix, usable, whole

#: Passes at most, how near to 0 or 1 the eigenvalues of the last Gram matrix have to be, and numbers handled at once.
PASSES, NEAR, STEP = 8, 1e-13, 1 << 20
#: Singular values below this share of the largest are taken as zero.
RANK = 1e-12


@dataclass
class Whitening:
    """Size, sums and mean of the fit list; eigenvalues, falling, and unit eigenvectors (columns) of its covariance."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    passes: int = 0
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        return (x - self.mean) @ self.vectors[:, :k] / np.sqrt(self.values[:k])


def solve(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows / upper`` by substitution, column by column, for all rows at once."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _steps(batches: Iterator[pa.RecordBatch], d: int, column: str = "x") -> Iterator[np.ndarray]:
    size = max(1, STEP // max(d, 1))
    for batch in batches:
        x = matrix(batch.column(batch.schema.get_field_index(column)), d)
        for a in range(0, len(x), size):
            yield x[a:a + size]


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sums per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for x in _steps(batches, d):
            n += len(x)
            small = np.abs(x.astype(np.float64)).max(initial=0) * len(x) < 2.0 ** 62
            part = (x if small else x.astype(object)).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, part)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), pa.array([str(t) for t in [*total, n]])], ["cell", "value"])

    found = map_arrow(fit, run, "cell int, value string").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("v")).collect()
    by_cell = {r["cell"]: int(r["v"]) for r in found}
    return by_cell.get(d, 0), [by_cell.get(i, 0) for i in range(d)]


def _gram(fit: DataFrame, d: int, width: int, rows_of) -> np.ndarray:
    """Sum of ``q.T @ q`` over ``q = rows_of(x)``, ``width`` columns wide: the cells of each task are added up by Spark."""
    cells = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for x in _steps(batches, d):
            q = rows_of(x.astype(np.float64))
            total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells[0]), dtype=np.int32)), pa.array(total[cells])], ["cell", "value"])

    out = np.zeros((width, width))
    for r in map_arrow(fit, run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("v")).collect():
        i, j = cells[0][r["cell"]], cells[1][r["cell"]]
        out[i, j] = out[j, i] = r["v"]
    return out


def _mean_of(fit: DataFrame, d: int, width: int, rows_of, n: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for x in _steps(batches, d):
            total += rows_of(x.astype(np.float64)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    out = np.zeros(width)
    for r in map_arrow(fit, run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("v")).collect():
        out[r["cell"]] = r["v"] / n
    return out


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper Cholesky factor; shifted in the first pass, later only where the matrix is not positive definite."""
    d = len(gram)
    unit, size = np.finfo(float).eps / 2, float(np.trace(gram))
    shift = 11 * (n * d + d * (d + 1)) * unit * size if first else 0.0
    shift = min(shift, 1e-3 * size)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(2 * shift, d * unit * size, np.finfo(float).tiny)


def fit(x: DataFrame, d: int, components: int) -> Whitening:
    """Whitening of the rows of ``x`` (column ``x``, lists of ``d`` longs), a stored table without repeated rows."""
    n, sums = _sums(x, d)
    mean = np.array([s / n for s in sums]) if n else np.zeros(d)
    found = Whitening(n, sums, mean, np.zeros(0), np.zeros((d, 0)))
    if not n or not d:
        return found
    factors: list[np.ndarray] = []
    whole_r = np.eye(d)
    for turn in range(PASSES):
        done = list(factors)

        def rows_of(a: np.ndarray) -> np.ndarray:
            a = a - mean
            for r in done:
                a = solve(a, r)
            return a

        gram = _gram(x, d, d, rows_of)
        if not np.trace(gram) > 0:
            return found
        factors.append(_factor(gram, n, turn == 0))
        whole_r = factors[-1] @ whole_r
        found.passes = turn + 1
        if turn:
            values = np.linalg.eigvalsh(gram)
            if np.all((np.abs(values - 1) < NEAR * d) | (values < NEAR * d)):
                break
    _, s, vt = np.linalg.svd(whole_r)
    rank = int((s > RANK * s[0]).sum())
    found.values, found.vectors = (s[:rank] ** 2 / n), vt[:rank].T.copy()
    k = min(components, rank)
    middle = _mean_of(x, d, k, lambda a: found.whitened(a, k), n)
    covariance = _gram(x, d, k, lambda a: found.whitened(a, k) - middle) / n
    found.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return found


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of ``(n * x - S) ** 2`` per row; None beyond 64 bits."""
    top = n * np.abs(x.astype(np.float64)).max(initial=0) + max((abs(s) for s in sums), default=0)
    if top < 2.0 ** 62 and top * top * max(x.shape[1], 1) < 2.0 ** 62:
        return ((x * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row per input row and component: ``doc`` (its other columns), ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error``.

    Rows take no part whose vector is null, has null or non-finite entries, or another length than most vectors have
    (the longer of equally frequent lengths). Entries become ``floor(256 * c)``; equal vectors count once in the fit but
    each row gets its results, also repeated rows. Components without variance are left out, so vectors that are all
    equal, and an empty table, give no rows. ``deviation`` is null where it exceeds 64 bits. Only matrices as wide as a
    vector come to the driver.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in embeddings.columns if c != vector]) if len(embeddings.columns) > 1 else F.struct(F.lit(None).alias("none"))
    rows = stored(embeddings.where(usable(vector)).select(doc.alias("doc"), whole(vector).alias("x")))
    d = dimension(rows, "x")
    rows = rows.where(F.size("x") == d)
    model = fit(stored(rows.select("x").distinct()), d, components)
    k = min(components, len(model.values))
    share = (model.values / model.values.sum()).tolist() if k else []
    fixed = [("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()),
             ("explained", pa.float64()), ("identity_error", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, STEP // max(d, 1))
        for batch in batches:
            for a in range(0, batch.num_rows if k else 0, size):
                part = batch.slice(a, size)
                x = matrix(part.column(1), d)
                m = len(x)
                w = model.whitened(x.astype(np.float64), k)
                away = _deviation(x, model.n, model.sums)
                turn = np.repeat(np.arange(m), k)
                values = [np.tile(np.arange(1, k + 1), m), np.full(m * k, model.n), [away[i] for i in turn], w.reshape(-1),
                          np.tile(share[:k], m), np.full(m * k, model.identity_error)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(turn)), *(pa.array(v, t) for v, (_, t) in zip(values, fixed))],
                                                 ["doc", *(name for name, _ in fixed)])

    shape = rows.select("doc", F.lit(0).alias("component"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"),
                        *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")]).schema
    for f in shape:
        f.nullable = True
    return map_arrow(rows, run, shape)
