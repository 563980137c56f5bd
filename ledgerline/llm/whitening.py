"""Whitening of vectors, with principal components by QDWH spectral divide-and-conquer.

The covariance is summed up by all tasks from centred whole numbers, one small matrix per task.
Its eigenvectors are found without an eigenvalue routine: the polar factor U of the covariance
less a shift is the matrix sign, so (U + I) / 2 projects onto the components of eigenvalues above
the shift and (I - U) / 2 onto the others.  The polar factor comes from the dynamically weighted
Halley iteration in its inverse-free form (two QR-like steps in double precision, at most some
ten rounds whatever the condition).  Orthonormal bases of both subspaces turn the matrix into two
smaller ones, which are split alike down to single components.  Matrices have the width of the
vectors, never more than ``WIDEST`` on a side, and are all the driver sees of the data.

The transform (components over the root of their variances) is then sent to all tasks, which
whiten their rows; a last pass sums up the covariance of what came out.

Defined results: vectors that are null, hold null or non-finite components, or components whose
number is beyond 2^26, are dropped, and so are those whose length is not the most common one; an
empty table gives an empty result; repeated rows and ids count each.  A component without
variance (less than 1e-13 of the total) has null whitened values and is left out of the identity
error, which is null if no component is left.  A deviation beyond a long is null.  Only the two
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.vectors import common_width, whole_vectors
from ledgerline.session import settled

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
WIDEST = 4096
NOTHING = 1e-13


def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by the QR form of the weighted Halley iteration."""
    size = len(a)
    x = a / (np.linalg.norm(a) or 1.0)  # no singular value above 1
    low = 1e-17  # lower bound of the singular values; it grows cubically towards 1
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        alpha = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, np.eye(size)]))
        after = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * q[:size] @ q[size:].T
        after = (after + after.T) / 2
        low = min(1.0, low * (alpha + beta * square) / (1 + gamma * square))
        step = np.linalg.norm(after - x)
        x = after
        if step <= 1e-15 * size and low > 0.99:
            break
        low = min(low, 1 - 1e-16)
    return x


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of a projector's range and of what is orthogonal to it."""
    # two steps of subspace iteration from the columns of largest norm
    order = np.argsort(-np.diag(projector), kind="stable")
    q = np.linalg.qr(projector[:, order])[0]
    image = projector @ q[:, :rank]
    q = np.linalg.qr(np.hstack([image, np.eye(len(projector))]))[0]
    return q[:, :rank], q[:, rank : len(projector)]


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of a symmetric matrix."""
    scale = np.linalg.norm(a)
    values, vectors = [], []
    stack = [(a, np.eye(len(a)))]
    while stack:
        block, basis = stack.pop()
        size = len(block)
        middle = np.trace(block) / size
        off = block - middle * np.eye(size)
        if size == 1 or np.linalg.norm(off) <= 4e-16 * scale:
            # one component, or several of the same eigenvalue
            values += np.diag(block).tolist()
            vectors += list(basis.T)
            continue
        for shift in _shifts(block):
            sign = polar(block - shift * np.eye(size))
            rank = round((np.trace(sign) + size) / 2)
            if 0 < rank < size:
                upper, lower = _bases((sign + np.eye(size)) / 2, rank)
                crossed = np.linalg.norm(upper.T @ block @ lower)
                if crossed <= 1e-12 * scale:
                    break
        else:
            upper, lower = _bases((sign + np.eye(size)) / 2, max(1, min(size - 1, rank)))
        for part in (upper, lower):
            inner = part.T @ block @ part
            stack.append(((inner + inner.T) / 2, basis @ part))
    v = np.linalg.qr(_polished(a, np.linalg.qr(np.array(vectors).T)[0]))[0]
    e = np.einsum("ij,ik,kj->j", v, a, v)
    order = np.argsort(-e, kind="stable")
    return e[order], v[:, order]


def _shifts(block: np.ndarray) -> Iterator[float]:
    """Places to split: between the diagonal's values, the widest gap near the middle first."""
    d = np.sort(np.diag(block))
    gaps = np.diff(d)
    weight = gaps * np.minimum(np.arange(1, len(d)), len(d) - np.arange(1, len(d)))
    for k in np.argsort(-weight, kind="stable")[:8]:
        yield (d[k] + d[k + 1]) / 2
    radius = np.linalg.norm(block - np.diag(np.diag(block)))
    for part in (0.5, 0.25, 0.75, 0.1, 0.9):
        yield d[0] - radius + part * (d[-1] - d[0] + 2 * radius)


def _polished(a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A step of refinement, which squares what error is left in the eigenvectors.

    Those of nearly equal eigenvalues are any basis of their common subspace and stay as they are.
    """
    r = np.eye(len(a)) - v.T @ v
    s = v.T @ a @ v
    e = np.diag(s) / (1 - np.diag(r))
    gap = e[None, :] - e[:, None]
    apart = np.abs(gap) > 1e-8 * np.linalg.norm(a)
    return v + v @ np.where(apart, (s + e[None, :] * r) / np.where(apart, gap, 1.0), r / 2)


@dataclass(frozen=True)
class Whitening:
    """What the fit learned; ``transform`` maps (x - floor(mean)) - ``rest`` to whitened values."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray  # width x components
    transform: np.ndarray
    explained: np.ndarray
    varies: np.ndarray

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])


def _matrix(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(len(column), width)


def _column_sums(rows: DataFrame, name: str, width: int, exact: bool) -> list:
    """Sums per position of an array column, one row per task and position shuffled."""
    kind = pa.int64() if exact else pa.float64()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64 if exact else np.float64)
        for batch in batches:
            total += _matrix(batch.column(0), width, total.dtype.type).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total, kind)], names=["at", "s"])

    told = rows.select(name).mapInArrow(summed, f"at int, s {'long' if exact else 'double'}")
    s = F.sum(F.col("s").cast("decimal(38,0)")) if exact else F.sum("s")
    out = [0] * width
    for r in told.groupBy("at").agg(s.alias("s")).collect():
        out[r["at"]] = int(r["s"]) if exact else r["s"]
    return out


def _covariance(rows: DataFrame, name: str, n: int, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Covariance of an array column, centred by ``base`` + ``rest`` before it is multiplied."""
    width = len(base)
    upper = np.triu_indices(width)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = (_matrix(batch.column(0), width, base.dtype.type) - base) - rest
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(upper[0]), dtype=np.int32)), pa.array(total[upper])], names=["cell", "s"]
        )

    told = rows.select(name).mapInArrow(summed, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    out = np.zeros((width, width))
    for r in told.collect():  # as many rows as the matrix has cells
        i, j = upper[0][r["cell"]], upper[1][r["cell"]]
        out[i, j] = out[j, i] = r["s"] / n
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of whole vectors ``x`` of one length; None without rows."""
    n = rows.count()
    if not n:
        return None
    width = len(rows.select("x").first()["x"])
    if width > WIDEST:
        raise ValueError(f"vectors of {width} components; the covariance is kept up to {WIDEST}")
    sums = _column_sums(rows, "x", width, exact=True)
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    values, vectors = spectral(_covariance(rows, "x", n, base, rest)) if width else (np.empty(0), np.empty((0, 0)))
    total = values.sum()
    first = slice(0, min(components, width))
    e, v = values[first], vectors[:, first]
    varies = e > NOTHING * total
    root = np.sqrt(np.where(varies, e, 1.0))
    explained = e / total if total > 0 else np.zeros(len(e))
    return Whitening(n, sums, e, v, v / root, explained, varies)


def _deviation(x: Column, n: int, sums: list[int]) -> Column:
    """Sum over components of (n x - S) squared, null beyond a long."""
    long = lambda v: F.lit(v).cast("long")
    apart = F.zip_with(x, F.array(*map(long, sums)), lambda a, s: F.try_subtract(F.try_multiply(a, long(n)), s))
    return F.aggregate(apart, long(0), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def whitened(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """One row per vector kept: id, ``n``, ``deviation``, ``whitened`` (one value per component),
    ``explained`` (likewise) and ``identity_error``."""
    kept = settled(whole_vectors(vectors, vector_column, scale, offset, id=id_column))
    width = common_width(kept)
    rows = kept.where(F.size("x") == F.lit(width))
    model = None if width is None else fit(rows, components)
    if model is None:
        none = F.array().cast("array<double>")
        return rows.select(
            F.col("id").alias(id_column), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
            none.alias("whitened"), none.alias("explained"), F.lit(None).cast("double").alias("identity_error"),
        )
    base, rest, transform = model.base, model.rest, model.transform
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (_matrix(batch.column("x"), len(base), np.int64) - base) - rest
            out = x @ transform
            flat = pa.array(out.ravel(), pa.float64())
            offsets = pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("deviation"), pa.ListArray.from_arrays(offsets, flat)],
                names=["id", "deviation", "whitened"],
            )

    ready = rows.select("id", "x", _deviation(F.col("x"), model.n, model.sums).alias("deviation"))
    done = settled(ready.mapInArrow(run, f"id {kind}, deviation long, whitened array<double>"))
    error = identity_error(done, model)
    shown = F.transform("whitened", lambda w, i: F.when(F.array(*map(F.lit, model.varies.tolist()))[i], w))
    return done.select(
        F.col("id").alias(id_column),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        (shown if len(model.values) else F.col("whitened")).alias("whitened"),
        F.array(*map(F.lit, model.explained.tolist())).cast("array<double>").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def identity_error(done: DataFrame, model: Whitening) -> float | None:
    """Largest entry, without its sign, of the whitened values' covariance less the identity."""
    if not model.varies.any():
        return None
    width = len(model.values)
    mean = np.array(_column_sums(done, "whitened", width, exact=False)) / model.n
    seen = _covariance(done, "whitened", model.n, mean, np.zeros(width))[np.ix_(model.varies, model.varies)]
    return float(np.abs(seen - np.eye(len(seen))).max())
