"""Embedding whitening by mixed-precision eigenvectors.

Entries become integers (``floor(scale * c) + offset``).  Over the distinct vectors Spark adds
up the covariance: vectors are centred on the rounded mean, which keeps them integers, so that
the sums of products are exact in any order; the rest of the mean, at most a half, is taken off
afterwards in rational arithmetic.  The driver holds the d x d covariance only.

Its eigenvectors are taken in float32 and then corrected by Ogita-Aishima steps, matrix products
alone, in extended precision.  The steps can't turn the vectors of (nearly) equal eigenvalues
into each other's right places, so such a cluster is solved again as a small problem of its own,
shifted to its centre, and the steps go on from there.

Defined results: null vectors, and vectors with null or non-finite entries, are left out; so are
empty ones and those of another length than the most frequent (of equally frequent ones, the
longest).  Components without variance (beyond rounding) are not returned; a table with fewer
than two distinct vectors has none, hence no rows.  Repeated rows and null ids come back row by
row; other columns are ignored.  Entries beyond the 64-bit integers saturate; ``deviation`` is
null where it is beyond them.  Every component's largest entry is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchwork.llm.common import write_scratch

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
STEPS = 40
_EXACT = float(1 << 53)


# the eigenproblem, on the driver: d x d

def _ogita_aishima(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One correction step: better vectors, their eigenvalues, what was wrong before, and the gap below which it can't separate."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # equal on both sides, so that a pair's rounding turns it, but keeps it at right angles
    e = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(e)
    gap = 2 * (np.sqrt((off ** 2).sum()) + np.sqrt((a ** 2).sum()) * np.sqrt((r ** 2).sum()))
    apart = e[None, :] - e[:, None]
    far = np.abs(apart) > gap
    step = np.where(far, (s + e[None, :] * r) / np.where(far, apart, 1), r / 2)
    return x + x @ step, e, float(max(np.abs(off).max(), np.abs(r).max())), float(gap)


def _clusters(e: np.ndarray, gap: float) -> Iterator[np.ndarray]:
    order = np.argsort(-e, kind="stable")
    cuts = np.flatnonzero(e[order][:-1] - e[order][1:] > gap) + 1
    yield from (c for c in np.split(order, cuts) if len(c) > 1)


def refined_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, right to double precision."""
    d = len(a)
    size = np.abs(a).max() if d else 0
    if not size:
        return np.zeros(d), np.eye(d)
    a = (a / size).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eps = float(np.finfo(np.longdouble).eps)
    settled = 0
    for _ in range(STEPS):
        x, e, wrong, gap = _ogita_aishima(a, x)
        settled = settled + 1 if wrong < 16 * d * eps else 0
        if settled == 2:
            break
        # what steps can't tell apart: a small problem, shifted so that its own size is that of the gaps
        for c in _clusters(e, gap):
            own = x[:, c]
            small = own.T @ (a @ own - own * e[c].mean())
            small = (small + small.T) / 2
            scale = np.abs(small).max()
            if scale > 64 * eps:
                turn = np.linalg.eigh((small / scale).astype(np.float64))[1].astype(np.longdouble)
                x[:, c] = own @ (turn @ (1.5 * np.eye(len(c)) - 0.5 * turn.T @ turn))  # right angles beyond float64
    x = x @ (1.5 * np.eye(d) - 0.5 * x.T @ x)
    e = np.array([x[:, i] @ (a @ x[:, i]) / (x[:, i] @ x[:, i]) for i in range(d)], np.longdouble)
    order = np.argsort(-e, kind="stable")
    e, x = e[order] * size, x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    top = x[np.abs(x).argmax(0), np.arange(d)]
    return e, x * np.where(top < 0, -1, 1)


# the sums, on the executors

def integers(vector: str | Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """``floor(scale * entry) + offset`` of every entry; null for vectors that are left out."""
    v = F.col(vector) if isinstance(vector, str) else vector
    v = v.cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & (F.size(v) > 0)
    top = float((1 << 62))
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), F.lit(float(scale)) * c))) + F.lit(offset).cast("long"))
    return F.when(F.coalesce(fine, F.lit(False)), whole)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), d)


def _upper_sums(fit: DataFrame, d: int, points, k: int) -> np.ndarray:
    """Sum of p p' over the fit list and, in the last row, of p; ``points`` gives the k-column points of a matrix of vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            p = points(_matrix(b.column("x"), d))
            total[:k] += p.T @ p
            total[k] += p.sum(0)
        i, j = np.nonzero(np.arange(k)[None, :] >= np.where(np.arange(k + 1) < k, np.arange(k + 1), 0)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])
    # k * (k + 3) / 2 numbers come to the driver, however many vectors there are
    rows = fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((k + 1, k))
    for r in rows:
        out[r.i, r.j] = r.v
        if r.i < k:
            out[r.j, r.i] = r.v
    return out


@dataclass
class Whitening:
    """What the fit list gives: its size and sums, and the components with positive variance."""

    n: int
    sums: list[int]
    mean: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def points(self):
        """The whitened points of a matrix of vectors, in double precision."""
        centre = np.array(self.mean, np.int64)
        rest = np.array([float(Fraction(s, self.n) - m) for s, m in zip(self.sums, self.mean)])
        turn = (self.vectors / np.sqrt(self.eigenvalues)).astype(np.float64)
        return lambda x: ((x - centre) - rest) @ turn


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of column ``x`` (written once, read in four passes); None where there are none."""
    rows = vectors.where(F.col("x").isNotNull())
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return None
    d = sizes[0].d
    distinct = write_scratch(rows.where(F.size("x") == d).select("x").distinct(), "whitening-fit")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("x"), d)
            low = (x & 0xFFFFFFFF).sum(0)  # in two halves, so that no sum leaves 64 bits
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows] * d), pa.array(range(d), pa.int32()), pa.array((x >> 32).sum(0)), pa.array(low)], names=["n", "i", "high", "low"])
    total = distinct.mapInArrow(sums, "n long, i int, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).orderBy("i").collect()
    n, added = total[0].n, [(int(r.high) << 32) + int(r.low) for r in total]
    mean = [round(Fraction(s, n)) for s in added]
    centre = np.array(mean, np.int64)
    # integers: exact while the sums stay below 2**53, else right to double precision
    products = _upper_sums(distinct, d, lambda x: (x - centre).astype(np.float64), d)
    if np.abs(products).max() < _EXACT:
        left = [s - n * m for s, m in zip(added, mean)]
        v = np.array([[np.longdouble(int(products[i, j]) * n - left[i] * left[j]) for j in range(d)] for i in range(d)]) / np.longdouble(n) ** 2
    else:
        v = products[:d].astype(np.longdouble) / n
    e, x = refined_eigen(v)
    trace = np.trace(v)
    keep = [k for k in range(min(components, d)) if e[k] > 64 * d * np.finfo(np.float64).eps * trace]
    model = Whitening(n, added, mean, e[keep], x[:, keep], (e[keep] / trace if keep else e[keep]).astype(np.float64))
    if keep:
        white = _upper_sums(distinct, d, model.points(), len(keep))
        average = white[-1] / n
        model.identity_error = float(np.abs(white[:-1] / n - np.outer(average, average) - np.eye(len(keep))).max())
    return model


def whiten(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    rows = docs.select(F.col(id_col).alias("id"), integers(vector_col, scale, offset).alias("x"))
    model = fit(rows, components)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.explained):
        return docs.sparkSession.createDataFrame([], schema)
    d, k = len(model.mean), len(model.explained)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # (d + 2) * components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        points, centre = model.points(), np.array(model.mean, np.int64)
        left = [s - model.n * m for s, m in zip(model.sums, model.mean)]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                x = _matrix(b.column("x"), d)
                z, m = x - centre, b.num_rows
                far = model.n * (int(np.abs(z).max()) + 1)
                if far * far * d < 1 << 63:
                    deviation = pa.array(((model.n * z - np.array(left, np.int64)) ** 2).sum(1))
                else:  # whole numbers of any size; beyond 64 bits the result is null
                    exact = [sum((model.n * int(c) - s) ** 2 for c, s in zip(row, left)) for row in z]
                    deviation = pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                     deviation.take(pa.array(each)), pa.array(points(x).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.where(F.size("x") == d).mapInArrow(run, schema)
