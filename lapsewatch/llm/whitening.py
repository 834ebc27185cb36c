"""Embedding whitening by Chebyshev-filtered subspace iteration.

The different vectors, as whole numbers, are packed into blocks and written once. Every further step needs the covariance
matrix V only as a product VQ with a narrow block Q; a pass over the blocks sums centred XᵀXQ, and the sums of all
tasks are added by Spark, so the driver holds dimensions x block numbers and no task more than one block of rows.

A few Lanczos steps estimate where the spectrum begins. Each iteration takes the Rayleigh-Ritz values of the block, damps the
spectrum from there to the block's smallest value by a Chebyshev polynomial of degree DEGREE (one pass a degree) and
orthogonalises by QR. It ends when each wanted pair is certified: the residual |Vq - eq| is at most CERTIFIED times
the largest eigenvalue, and no longer falls. One guard column is drawn anew each time, so that no direction is missed by
chance; where a flat spectrum stalls the iteration, the block doubles, at most to all dimensions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import commonest_width, finite, stored, table

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
#: Whole numbers are held to this before the shift.
LIMIT = 2**40
DEGREE, LANCZOS, OUTER, SEED = 12, 10, 40, 11
CERTIFIED, BEST = 1e-10, 1e-14


def integers(vector: Column) -> Column:
    return F.transform(vector.cast("array<double>"), lambda c: F.floor(
        F.greatest(F.least(c * F.lit(float(SCALE)), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))) + F.lit(SHIFT).cast("long"))


def _packed(width: int):
    def pack(batches):
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(len(batch.column(0)), width)
            if len(x):
                yield pa.RecordBatch.from_arrays([
                    pa.array([len(x)], pa.int64()), pa.array([x.sum(0)], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())],
                    ["n", "sums", "data"])

    return pack


@dataclass
class Fit:
    """What the fit list says: number of vectors, exact sums, and the eigenpairs once they are known."""

    n: int
    sums: list[int]
    vectors: np.ndarray | None = None  # dimensions x components
    values: np.ndarray | None = None
    trace: float = 0.0
    residual: float = 0.0
    passes: int = 0
    identity_error: float = 0.0

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Mean as whole part and remainder over n: x - mean is x - whole - rest / n, exact but for one rounding."""
        return np.array([s // self.n for s in self.sums], np.int64), np.array([s % self.n for s in self.sums], np.int64)


def _centred(x: np.ndarray, fit: Fit) -> np.ndarray:
    whole, rest = fit.whole()
    return (x - whole).astype(np.float64) - rest / fit.n


def _rows_out(rows: np.ndarray):
    if len(rows):
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(list(rows), pa.list_(pa.float64()))], ["i", "y"])


def _product(fit: Fit, block: np.ndarray):
    """Centred XᵀXQ of a task."""
    def multiply(batches):
        total = np.zeros_like(block)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = _centred(np.frombuffer(data, np.int64).reshape(-1, len(block)), fit)
                total += x.T @ (x @ block)
        yield from _rows_out(total)

    return multiply


def _moments(fit: Fit):
    """Sums and products of whitened values, and last the sum of squared deviations, of a task."""
    def add(batches):
        k = fit.vectors.shape[1]
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for data in batch.column(0).to_pylist():
                x = _centred(np.frombuffer(data, np.int64).reshape(-1, len(fit.sums)), fit)
                w = x @ fit.vectors / np.sqrt(fit.values)
                total[:k, :k] += w.T @ w
                total[k, :k] += w.sum(0)
                total[k, k] += (x * x).sum()
        yield from _rows_out(total)

    return add


def _summed(blocks: DataFrame, task, rows: int, columns: int) -> np.ndarray:
    """Matrices of all tasks, added in Spark; one row per matrix row reaches the driver."""
    parts = blocks.select("data").mapInArrow(task, "i int, y array<double>")
    sums = parts.groupBy("i").agg(F.array(*[F.sum(F.col("y")[k]) for k in range(columns)]).alias("y")).collect()
    out = np.zeros((rows, columns))
    for r in sums:
        out[r["i"]] = r["y"]
    return out


def _floor_of_spectrum(apply, start: np.ndarray) -> float:
    """Estimate of V's smallest eigenvalue by a few Lanczos steps, less its residual."""
    basis, alphas, betas = [start / np.linalg.norm(start)], [], []
    for _ in range(min(LANCZOS, len(start))):
        w = apply(basis[-1][:, None])[:, 0]
        alphas.append(w @ basis[-1])
        for q in basis + basis:
            w = w - (w @ q) * q
        betas.append(np.linalg.norm(w))
        if betas[-1] <= 1e-12 * max(map(abs, alphas)):
            break
        basis.append(w / betas[-1])
    off = betas[:len(alphas) - 1]
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(off, 1) + np.diag(off, -1))
    return max(0.0, values[0] - betas[-1] * abs(vectors[-1, 0]))


def _filtered(apply, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """Chebyshev polynomial of V on ``q``: small on [low, high], scaled to one at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = scale = half / (top - middle)
    before, now = q, (vq - middle * q) * (scale / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - scale)
        before, now = now, 2 * (apply(now) - middle * now) * (after / half) - scale * after * before
        scale = after
    return now


def _eigenpairs(apply, width: int, wanted: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, float]:
    size = min(width, 3 * wanted)
    low = _floor_of_spectrum(apply, rng.normal(size=width))
    q = np.linalg.qr(rng.normal(size=(width, size)))[0]
    last = np.inf
    for _ in range(OUTER):
        vq = apply(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(values[0], 0.0)
        residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()
        if residual <= BEST * top or residual <= CERTIFIED * top and residual > last / 2 or size == width:
            break
        stalled = residual > last / 2
        last = residual
        high = max(values[-1], 1e-6 * top)
        new = rng.normal(size=(width, max(1, min(size, width - size) if stalled else 1)))
        y = _filtered(apply, q, vq, min(low, high / 2) if low >= high else low, high, top)
        size = min(width, 2 * size) if stalled else size
        q = np.linalg.qr(np.hstack([y[:, :size - new.shape[1]], new]))[0]
    if residual > CERTIFIED * top:
        raise ArithmeticError(f"eigenpairs not certified: residual {residual:g} of {top:g}")
    keep = values[:wanted] > width * np.finfo(float).eps * top
    return q[:, :wanted][:, keep], values[:wanted][keep], residual


def _rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    return vectors.where(finite(F.col(vector))).select(F.col(key).alias("id"), integers(F.col(vector)).alias("x"))


def fit(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> Fit | None:
    """Sums, eigenpairs and the whitening error over the different vectors; None without vectors.

    Vectors that are null or hold null or non-finite components take no part, nor do those whose length is not the
    commonest one (ties to the longer). Components saturate at LIMIT after scaling. Vectors that repeat count
    once. There are as many components as dimensions at most, and none for eigenvalues that are zero to double precision.
    """
    rows = _rows(vectors, key, vector)
    width, _ = commonest_width(rows, "x")
    if not width:
        return None
    blocks = stored(rows.where(F.size("x") == width).select("x").distinct().mapInArrow(_packed(width), "n long, sums array<long>, data binary"))
    n = blocks.agg(F.sum("n")).first()[0]
    sums = blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s")).collect()
    out = Fit(n, [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])])

    def apply(q: np.ndarray) -> np.ndarray:
        out.passes += 1
        return _summed(blocks, _product(out, np.ascontiguousarray(q)), *q.shape) / n

    out.vectors, out.values, out.residual = _eigenpairs(apply, width, min(components, width), np.random.default_rng(SEED))
    k = len(out.values)
    m = _summed(blocks, _moments(out), k + 1, k + 1) / n
    out.trace = float(m[k, k])
    out.identity_error = float(np.abs(m[:k, :k] - np.outer(m[k, :k], m[k, :k]) - np.eye(k)).max()) if k else 0.0
    return out


def _deviations(x: np.ndarray, fit: Fit) -> list[int | None]:
    """Sum over dimensions of (n x - S)², exact; null beyond 64 bits."""
    whole, rest = fit.whole()
    off = x - whole
    most = fit.n * (int(np.abs(off).max(initial=0)) + 1)
    if most * most * x.shape[1] < 2**63:
        return ((fit.n * off - rest) ** 2).sum(1).tolist()
    exact = ((fit.n * off.astype(object) - rest.astype(object)) ** 2).sum(1).tolist()
    return [d if d < 2**63 else None for d in exact]


def _whitened(fit: Fit):
    k = len(fit.values)

    def whiten(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(len(batch.column(1)), len(fit.sums))
            w = _centred(x, fit) @ fit.vectors / np.sqrt(fit.values)
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(_deviations(x, fit), pa.int64()).take(pa.array(row)), pa.array(w.ravel())],
                ["id", "component", "deviation", "whitened"])

    return whiten


def whiten(vectors: DataFrame, model: Fit | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, deviation, whitened): a row for each vector of the model's length and each component. One scan, no shuffle.

    Rows that repeat stay; null ids stay. Without a model, or with none but zero eigenvalues, there are no rows.
    """
    rows = _rows(vectors, key, vector)
    if model is None or not len(model.values):
        none = rows.where("false").selectExpr("id", "1 AS component", "0L AS deviation", "0D AS whitened")
        return none.withColumnRenamed("id", key)
    kind = f"id {dict(rows.dtypes)['id']}, component int, deviation long, whitened double"
    return rows.where(F.size("x") == len(model.sums)).mapInArrow(_whitened(model), kind).withColumnRenamed("id", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of all embeddings, each with its share of the variance."""
    vectors = table(spark, sf_dir, "embeddings")
    model = fit(vectors)
    shares = [float(v) / model.trace for v in model.values] if model and len(model.values) else []
    explained = F.get(F.array(*map(F.lit, shares)), F.col("component") - 1) if shares else F.lit(0.0)
    return whiten(vectors, model).select(
        "vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        explained.alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"))
