"""Embedding whitening by shifted CholeskyQR over distinct integer vectors.

Entries are quantised to integers, ``floor(scale * c)``; the fit list holds each distinct integer vector once, as a table.
A pass sums the Gram matrix of the centred rows, multiplied by the inverses of the factors found so far (one triangular
solve each); its Cholesky factor is the next one. A pass whose Gram matrix is not safely definite gets a shift on its
diagonal, so columns that depend on each other, or nearly do, are made orthogonal step by step; passes go on until the
rows are orthonormal. The factors' product is the R of the centred rows: its singular values and right vectors are the
components, which a Gram matrix alone would give to half the digits only.

Sums of entries are exact integers. Rows are centred by the mean's integer part first, exactly, then by its fraction.
Every task sends one triangle of numbers per pass and Spark adds them, so the driver sees dim x dim numbers whatever the
input; a vector that stands in a third of all rows is one row of the fit list.

Cases: a null vector, one with a null, NaN or infinite entry, and one whose length is not the table's (the most frequent
length of usable vectors; the smaller of two equally frequent) are dropped. Repeated rows are rows of the result each and
one row of the fit; null ids stay null. Directions without variance (a singular value below ``dim * eps`` of the largest) are no
components: a table whose vectors are all equal, and an empty table, give no rows. Of equal eigenvalues any basis may
come, the same for all rows. Quantised entries end at 2^61 either way; ``deviation`` is exact, a decimal, and null beyond
38 digits. Extra columns of the input are not read, and column names are this module's own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricedex.llm.common import materialise

SCALE = 256
MAX_PASSES = 12
BLOCK = 4096  # rows of a block in a task
LARGEST = 1 << 61  # quantised entries end here, so that centring cannot overflow
EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """The fitted model: ``vectors`` holds one unit eigenvector a column, by falling eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    eigenvalues: np.ndarray
    total: float  # trace of the covariance
    identity_error: float


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, x array<long>) of the usable vectors."""
    entries = F.transform(vector_col, lambda c: c.cast("double"))
    usable = F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = F.transform(entries, lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))), F.lit(LARGEST)), F.lit(-LARGEST)))
    return vectors.where(usable).select(F.col(id_col).alias("vec_id"), x.alias("x"))


def _of_one_length(rows: DataFrame) -> DataFrame:
    """Rows of the most frequent vector length; at most one number a length comes to the driver."""
    width = F.size("x")
    best = (rows.groupBy(width.alias("width")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "width").limit(1).collect())
    return rows.where(width == best[0].width) if best else rows.where(F.lit(False))


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches in slices of bounded size, with their vectors as a matrix."""
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _mean(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Whole and fractional part of the mean of each dimension."""
    return np.array([s // n for s in sums], np.int64), np.array([(s % n) / n for s in sums])


def _centre(x: np.ndarray, whole: np.ndarray, fraction: np.ndarray) -> np.ndarray:
    """x less the mean, whose integer part is taken off exactly."""
    return (x - whole).astype(np.float64) - fraction


def _triangle(rows: DataFrame, dim: int, transform: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the outer products of ``transform(x)``: one triangle a task, added by Spark."""
    wide = len(transform(np.zeros((1, dim), np.int64))[0])
    i, j = np.triu_indices(wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((wide, wide))
        for _, block in _blocks(batches, dim):
            q = transform(block)
            gram += q.T @ q
        yield pa.RecordBatch.from_pydict({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": gram[i, j]})

    found = rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros((wide, wide))
    out[found["i"], found["j"]] = found["v"]
    return np.triu(out) + np.triu(out, 1).T


def _lower_solve(factor: np.ndarray, q: np.ndarray) -> np.ndarray:
    """q times the inverse of the upper triangular ``factor``, column by column (forward substitution on the transpose)."""
    out = np.empty(q.shape, order="F")
    for k in range(factor.shape[0]):
        out[:, k] = (q[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def _factor(gram: np.ndarray, n: int) -> tuple[np.ndarray, bool]:
    """Upper Cholesky factor of the Gram matrix, shifted (and True) unless it is safely definite."""
    dim = len(gram)
    norm = float(np.linalg.norm(gram, 2))
    # the customary bound, with the square root of n terms: rows are added in blocks, blocks in tasks, tasks by Spark
    shift = 11 * (float(n) ** 0.5 * dim + dim * (dim + 1)) * EPS / 2 * norm
    if np.linalg.eigvalsh(gram)[0] > shift:
        return np.linalg.cholesky(gram).T, False
    return np.linalg.cholesky(gram + shift * np.eye(dim)).T, True


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """Fit the first components on the distinct vectors of ``rows`` (column x, of one length); None without variance."""
    distinct = materialise(rows.select("x").distinct(), "distinct-vectors")
    # as decimals: exact, and combined in every task before the shuffle
    parts = distinct.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    found = sorted(parts.collect(), key=lambda r: r.i)
    if not found:
        return None
    n, sums, dim = found[0].n, [int(r.s) for r in found], len(found)
    whole, fraction = _mean(n, sums)

    factors: list[np.ndarray] = []
    scale = None

    def orthogonalised(block: np.ndarray) -> np.ndarray:
        q = _centre(block, whole, fraction)
        if scale is not None:
            q = q / scale
        for f in factors:
            q = _lower_solve(f, q)
        return q

    gram = _triangle(distinct, dim, orthogonalised)
    root = np.sqrt(np.diag(gram))
    if not root.any():
        return None
    # columns of very different lengths are brought to one length first: a diagonal first factor
    scale = np.where(root > 0, root, 1.0)
    gram = gram / scale / scale[:, None]
    flat = root == 0
    gram[flat, flat] = 1.0  # a dimension without variance stays out of the way: its rows are zero in every pass
    for _ in range(MAX_PASSES):
        upper, shifted = _factor(gram, n)
        factors.append(upper)
        gram = _triangle(distinct, dim, orthogonalised)
        gram[flat, flat] = 1.0
        if not shifted and np.abs(gram - np.eye(dim)).max() < 1e-13 * dim:
            break
    # what the last pass leaves of the Gram matrix goes into R by its symmetric root, which dependent columns have too
    left, turn = np.linalg.eigh(gram)
    product = np.sqrt(np.maximum(left, 0.0))[:, None] * turn.T
    for f in reversed(factors):
        product = product @ f
    product = product * scale
    product[:, flat] = 0.0
    singular, vectors = np.linalg.svd(product)[1:]
    keep = min(components, int((singular > 16 * dim * EPS * singular[0]).sum()))
    vectors = vectors[:keep].T
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(keep)])
    vectors = vectors * sign
    values = singular[:keep] ** 2 / n
    width = np.sqrt(values)

    def whiten(block: np.ndarray) -> np.ndarray:
        return np.hstack([_centre(block, whole, fraction) @ vectors / width, np.ones((len(block), 1))])

    last = _triangle(distinct, dim, whiten) / n
    mean = last[:-1, -1]
    error = float(np.abs(last[:-1, :-1] - np.outer(mean, mean) - np.eye(keep)).max())
    return Whitening(n, sums, vectors, values, float((singular ** 2).sum() / n), error)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over dimensions of (n x - S)^2: in longs where they cannot overflow, else in whole numbers of any size."""
    high, low = x.max(axis=0).tolist(), x.min(axis=0).tolist()
    far = [max(abs(n * h - s), abs(n * v - s)) for h, v, s in zip(high, low, sums, strict=True)]
    largest = max(map(abs, [*(n * h for h in high), *(n * v for v in low), *sums]))
    if largest < 1 << 63 and sum(f * f for f in far) < 1 << 63:
        d = n * x - np.array(sums, np.int64)
    else:
        d = n * x.astype(object) - np.array(sums, object)
    return (d * d).sum(axis=1).tolist()


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation (decimal), whitened, explained, identity_error."""
    n, sums, vectors, keep = model.n, model.sums, model.vectors, len(model.eigenvalues)
    whole, fraction = _mean(n, sums)
    width = np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, len(sums)):
            w = _centre(x, whole, fraction) @ vectors / width
            row = pa.array(np.repeat(np.arange(len(x)), keep))
            deviation = pa.array([str(d) for d in _deviation(x, n, sums)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(row), pa.array(np.tile(np.arange(1, keep + 1, dtype=np.int32), len(x))),
                 deviation.take(row), pa.array(w.ravel())], ["vec_id", "component", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"vec_id {kind}, component int, deviation string, whitened double")
    share = F.element_at(F.array(*[F.lit(float(v / model.total)) for v in model.eigenvalues]), F.col("component"))
    return found.select("vec_id", "component", F.lit(n).cast("long").alias("n"),
                        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"), "whitened",
                        share.alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def whiten(vectors: DataFrame, components: int = 4, scale: int = SCALE, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Fit on the distinct usable vectors and whiten every usable row."""
    rows = _of_one_length(quantised(vectors, id_col, vector_col, scale))
    model = fit(rows, components)
    if model is not None:
        return transform(rows, model)
    none = F.lit(None)
    return rows.where(F.lit(False)).select(
        "vec_id", none.cast("int").alias("component"), none.cast("long").alias("n"), none.cast("decimal(38,0)").alias("deviation"),
        *[none.cast("double").alias(c) for c in ("whitened", "explained", "identity_error")])
