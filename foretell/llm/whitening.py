"""Whitening of embeddings: exact variances of entries and of sums of two entries give all covariances."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import spare_name, with_fields
from foretell.session import scratch_path, ship_package

#: Rows whose squares are summed at a time: products of two 24-bit parts stay exact in 64 bits.
BLOCK_ROWS = 1 << 13
LIMB = 1 << 32
#: Eigenvalues below this share of the trace are zero up to rounding.
ZERO_SHARE = 1e-13
WIDE = Decimal(10) ** 38


def integer_vectors(table: DataFrame, vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``table`` with ``x``: floor(scale * entry) of every entry, for rows whose vector has no null or non-finite entry.

    Entries beyond 64 bits are the largest or least 64-bit number.
    """
    x = spare_name(table, "x")
    entries = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    floors = F.transform(entries, lambda c: F.floor(c * float(scale)))
    return table.where(F.col(vector_col).isNotNull() & F.coalesce(whole, F.lit(False))).withColumn(x, floors)


def _rows(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten())
    starts = np.cumsum(sizes) - sizes
    out = {}
    for d in np.unique(sizes).tolist():
        if d:
            at = np.flatnonzero(sizes == d)
            out[d] = at, flat[starts[at][:, None] + np.arange(d)]
    return out


def _sums(batches):
    """Count and sum of each dimension, by length of vector."""
    total: dict[int, list] = {}
    for batch in batches:
        for d, (at, x) in _rows(batch.column("x")).items():
            known = total.setdefault(d, [0, np.zeros(d, object)])
            known[0] += len(at)
            high, low = x >> 32, x & (LIMB - 1)  # halves, as sums of 64-bit numbers overflow
            known[1] += high.sum(axis=0).astype(object) * LIMB + low.sum(axis=0).astype(object)
    for d, (n, s) in total.items():
        yield pa.RecordBatch.from_pydict({
            "d": pa.array([d] * d, pa.int64()), "i": pa.array(range(d), pa.int64()), "n": pa.array([n] * d, pa.int64()),
            "s": pa.array([Decimal(v) for v in s.tolist()], pa.decimal128(38, 0)),
        })


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n * x - s, in 64 bits where they hold it, else as Python's integers."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0))) * n + max(map(abs, s))
    if most < 1 << 46:  # the sum of two fits in twice 24 bits
        return x * n - np.array(s, np.int64)
    return x.astype(object) * n - np.array(s, object)


def _squares(y: np.ndarray) -> np.ndarray:
    """Exact column sums of squares, as Python's integers."""
    if y.dtype == object:
        return (y * y).sum(axis=0)
    high, low = y >> 24, y & 0xFFFFFF
    parts = [np.einsum("ij,ij->j", a, b).astype(object) for a, b in ((high, high), (high, low), (low, low))]
    return parts[0] * (1 << 48) + parts[1] * (1 << 25) + parts[2]


def _variance_sums(fits: dict[int, tuple[int, list[int]]]):
    """Sums of squares of every centred dimension (i = j) and of every sum of two of them, in 32-bit limbs."""

    def run(batches):
        total = {d: np.zeros((d, d), object) for d in fits}
        for batch in batches:
            for d, (_, x) in _rows(batch.column("x")).items():
                y = centred(x, *fits[d])
                for k in range(0, len(y), BLOCK_ROWS):
                    part = y[k : k + BLOCK_ROWS]
                    for i in range(d):
                        total[d][i, i] += _squares(part[:, i : i + 1])[0]
                        total[d][i, i + 1 :] += _squares(part[:, i : i + 1] + part[:, i + 1 :])
        made: dict[str, list] = {c: [] for c in ("d", "i", "j", "limb", "value")}
        for d, t in total.items():
            for i in range(d):
                for j in range(i, d):
                    value, limb = int(t[i, j]), 0
                    while value:
                        for c, v in zip(made, (d, i, j, limb, value % LIMB)):
                            made[c].append(v)
                        value, limb = value // LIMB, limb + 1
        yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in made.items()})

    return run


class Whitening:
    """Mean, eigenvalues and unit eigenvectors of the vectors of one length."""

    def __init__(self, n: int, s: list[int], sums: list[list[int]], components: int):
        self.n, self.s, d = n, s, len(s)
        self.covariance = np.empty((d, d))
        for i in range(d):
            for j in range(i, d):
                # n^3 times the covariance: half the variance of the sum less both variances
                exact = sums[i][i] if i == j else (sums[i][j] - sums[i][i] - sums[j][j]) // 2
                self.covariance[i, j] = self.covariance[j, i] = exact / n**3
        values, vectors = np.linalg.eigh(self.covariance)
        self.values, self.vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        trace = float(np.trace(self.covariance))
        self.explained = self.values / trace if trace > 0 else np.full(len(self.values), np.nan)
        self.used = self.values > ZERO_SHARE * trace
        self.identity_error: float | None = None

    def transform(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centred vectors times n, and whitened coordinates (NaN where the component's variance is zero)."""
        y = centred(x, self.n, self.s)
        root = np.sqrt(np.where(self.used, self.values, np.nan))
        return y, (y.astype(np.float64) / self.n) @ self.vectors / root


def _moments(models: dict[int, Whitening]):
    """Sums of whitened coordinates and of their products."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, (_, x) in _rows(batch.column("x")).items():
                w = models[d].transform(x)[1]
                w = np.column_stack((np.ones(len(w)), w))
                total[d] = total.get(d, 0) + w.T @ w
        for d, t in total.items():
            a, b = np.indices(t.shape)
            yield pa.RecordBatch.from_pydict({"d": np.full(t.size, d), "a": a.ravel(), "b": b.ravel(), "v": t.ravel()})

    return run


def fit_whitening(vectors: DataFrame, components: int = 4) -> dict[int, Whitening]:
    """A model for each length of the vectors in ``x`` (64-bit integers); each distinct vector counts once.

    Three passes over the distinct vectors, which are written once: sums, squares about the exact mean, and
    the covariance of what comes out. The driver gets d^2 numbers per length d, whatever the number of vectors.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "whitening")
    vectors.select("x").where(F.size("x") > 0).distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    sums = fit.mapInArrow(_sums, "d long, i long, n long, s decimal(38,0)").groupBy("d", "i").agg(F.sum("n"), F.sum("s"))
    means: dict[int, tuple[int, dict[int, int]]] = {}
    for d, i, n, s in sums.collect():
        means.setdefault(d, (n, {}))[1][i] = int(s)
    fits = {d: (n, [s[i] for i in range(d)]) for d, (n, s) in means.items()}
    squares = fit.mapInArrow(_variance_sums(fits), "d long, i long, j long, limb long, value long")
    exact = {d: [[0] * d for _ in range(d)] for d in fits}
    for d, i, j, limb, value in squares.groupBy("d", "i", "j", "limb").agg(F.sum("value")).collect():
        exact[d][i][j] += value * LIMB**limb
    models = {d: Whitening(n, s, exact[d], components) for d, (n, s) in fits.items()}
    moments = fit.mapInArrow(_moments(models), "d long, a long, b long, v double").groupBy("d", "a", "b").agg(F.sum("v"))
    tables = {d: np.zeros((len(m.values) + 1,) * 2) for d, m in models.items()}
    for d, a, b, v in moments.collect():
        tables[d][a, b] = v
    for d, m in models.items():
        mean = tables[d][0, 1:] / m.n
        off = tables[d][1:, 1:] / m.n - np.outer(mean, mean) - np.eye(len(mean))
        kept = off[np.ix_(m.used, m.used)]
        m.identity_error = float(np.abs(kept).max()) if kept.size else None
    return models


def whiten(table: DataFrame, vector_col: str = "embedding", *, components: int = 4, scale: int = 256) -> DataFrame:
    """Rows of ``table`` with whole vectors, one for each of the first ``components`` components.

    Vectors that are null or hold null or non-finite entries are left out; the rest becomes x = floor(scale * entry).
    Vectors of different lengths are whitened apart; empty ones have no component. Every row gets its result,
    but equal x count once in the fit. Instead of ``vector_col``, a row has ``component`` (from 1, by falling
    variance), ``n`` (distinct vectors), ``deviation`` (sum over dimensions of (n x - S)^2, exact; null beyond 38
    digits), ``whitened``, ``explained`` (share of the variance), ``identity_error`` (largest entry of the
    whitened covariance less the identity, over the fit). A component without variance has null ``whitened``; without any variance,
    ``explained`` and ``identity_error`` are null too. Columns of ``table`` with these names are replaced.
    """
    added = {
        "component": "int", "n": "long", "deviation": "decimal(38,0)", "whitened": "double", "explained": "double", "identity_error": "double",
    }
    rows = integer_vectors(table.drop(*[c for c in added if c != vector_col]), vector_col, scale)
    x = rows.columns[-1]
    models = fit_whitening(rows.select(F.col(x).alias("x")), components)
    kept = rows.drop(vector_col)
    schema = with_fields(kept.drop(x), ", ".join(f"{name} {kind}" for name, kind in added.items()))

    def number(values):
        return pa.array([None if v is None or np.isnan(v) else float(v) for v in values], pa.float64())

    def run(batches):
        for batch in batches:
            rest = batch.drop_columns([x])
            for d, (at, vectors) in _rows(batch.column(x)).items():
                m, take = models[d], pa.array(at)
                y, w = m.transform(vectors)
                safe = y.dtype != object and d * int(np.abs(y).max()) ** 2 < 1 << 63
                squares = (y * y).sum(axis=1).tolist() if safe else (y.astype(object) ** 2).sum(axis=1).tolist()
                squares = pa.array([Decimal(v) if v < WIDE else None for v in squares], pa.decimal128(38, 0))
                for k in range(len(m.values)):
                    own = [
                        pa.array([k + 1] * len(at), pa.int32()), pa.array([m.n] * len(at), pa.int64()), squares, number(w[:, k]),
                        number([m.explained[k]] * len(at)), pa.array([m.identity_error] * len(at), pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays([*rest.take(take).columns, *own], names=schema.names)

    return kept.mapInArrow(run, schema)
