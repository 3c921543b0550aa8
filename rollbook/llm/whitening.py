"""Whitening of embeddings by spectral divide and conquer of their covariance.

Each component c of a vector becomes the integer floor(scale * c) + offset.

1. One pass sums the integers of each dimension (exactly) and counts the vectors.
2. A second pass centres each vector by the sums (n * x - S, an exact integer) and adds
   up the products of its dimensions; tasks send one row per pair of dimensions, which Spark adds.
3. On the driver, on that one square matrix: the polar factor of the covariance less a shift,
   by dynamically weighted Halley steps with QR factors (QDWH), is 1 on the space of the
   eigenvalues above the shift and -1 below.  Its projector parts the space in two, and
   each part is parted again until single directions, the components, are left.  Parts
   that can hold none of the components asked for are left alone.
4. A third pass projects the centred vectors; sums and components travel with the task's
   function, (dimensions) * (components) numbers.

No task holds more than a batch and one matrix of the dimensions, and nothing else reaches
the driver.  Equal vectors are ordinary rows, so a vector that very many rows share is only
many rows of a scan.

Vectors that are null or hold null or non-finite entries take no part.  Dimensions missing at
the end of a shorter vector count as c = 0.  Rows with a null or repeated id are rows of
their own.  A component without variance (a constant dimension, a single vector) whitens
to 0.  Equal eigenvalues have any orthonormal components of their space.  An empty table
and vectors without dimensions give no rows.  Texts and other columns than id and vector are not
read; the result has its own columns only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.storage import written

EPSILON = float(np.finfo(np.float64).eps)
ROWS = 4096

# ---------------------------------------------------------------- eigenvectors


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH."""
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    low = EPSILON / n  # no singular value that counts is below
    for _ in range(30):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        alpha = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d)))
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, np.eye(n)]))
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (alpha + beta * low**2) / (1 + gamma * low**2))
        if moved < 1e-13 * np.sqrt(n) and 1 - low < 1e-12:
            break
    return x


def parted(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant spaces, that of greater eigenvalues first; None for a multiple of one."""
    n, size = len(a), np.linalg.norm(a)
    spread = np.diag(a)
    if np.linalg.norm(a - np.diag(spread)) <= EPSILON * size and np.ptp(spread) <= EPSILON * size:
        return None
    draw = np.random.default_rng(0)
    best = (np.inf, None)
    for attempt in range(12):
        # the mean lies strictly between the least and the greatest eigenvalue
        shift = spread.mean()
        if attempt:
            reach = np.linalg.norm(a - shift * np.eye(n), 2)
            shift += reach * (0.618 * attempt % 1 - 0.5) / 2
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        basis, _ = np.linalg.qr(projector @ draw.standard_normal((n, k)))
        basis, _ = np.linalg.qr(projector @ basis, mode="complete")
        left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if left < best[0]:
            best = (left, (basis[:, :k], basis[:, k:]))
        if left <= 8 * n * EPSILON * size:
            break
    return best[1]


def components(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a symmetric matrix and their unit vectors as columns."""

    def down(a: np.ndarray, basis: np.ndarray, wanted: int) -> list[np.ndarray]:
        if wanted <= 0:
            return []
        parts = parted(a) if len(a) > 1 else None
        if parts is None:
            return list(basis.T)
        found: list[np.ndarray] = []
        for part in parts:
            found += down(part.T @ a @ part, basis @ part, wanted - len(found))
        return found

    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    v = (v + v.T) / 2
    u = np.column_stack(down(v, np.eye(len(v)), min(wanted, len(v))))
    values = np.einsum("ij,ij->j", u, v @ u)
    order = np.argsort(-values, kind="stable")[:wanted]
    u = u[:, order]
    signs = np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])
    return np.maximum(values[order], 0), u * np.where(signs == 0, 1, signs)


# ---------------------------------------------------------------- passes


def quantised(vector: Column, scale: int, offset: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integers(df: DataFrame, key: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(id, x) of the usable rows."""
    rows = df.filter(usable(F.col(vector)))
    return rows.select(F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale, offset).alias("x"))


def matrices(batches: Iterator[pa.RecordBatch], width: int, missing: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``ROWS`` rows and their integers, shorter vectors filled up."""
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            column = batch.column(batch.schema.get_field_index("x"))
            lengths = np.diff(np.asarray(column.offsets))
            flat = np.asarray(column.flatten(), dtype=np.int64)
            if (lengths == width).all():
                yield batch, flat.reshape(len(lengths), width)
            else:
                x = np.full((len(lengths), width), missing, dtype=np.int64)
                x[np.arange(width) < lengths[:, None]] = flat
                yield batch, x


@dataclass(frozen=True)
class Whitening:
    """The fitted transform: n, sums S, eigenvalues and components, trace of the covariance."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    offset: int

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.values]

    def weights(self) -> np.ndarray:
        """Components over the root of their eigenvalue; those without variance are zero."""
        there = self.values > len(self.sums) * EPSILON * max(self.trace, 0)
        return self.components * np.divide(1, np.sqrt(self.values), out=np.zeros(len(self.values)), where=there)


def dimension_sums(x: DataFrame, offset: int) -> tuple[int, np.ndarray]:
    """The number of vectors and the exact sum of each dimension."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, there, rows = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for whole in batches:
            width = max(len(total), int(np.diff(np.asarray(whole.column(0).offsets)).max(initial=0)))
            total, there = (np.pad(a, (0, width - len(a))) for a in (total, there))
            for batch, values in matrices(iter([whole]), width, 0):
                lengths = np.diff(np.asarray(batch.column(0).offsets))
                total += values.sum(axis=0)
                there += (lengths[:, None] > np.arange(width)).sum(axis=0)
            rows += whole.num_rows
        at = np.arange(-1, len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(np.concatenate([[0], total])), pa.array(np.concatenate([[rows], there]))],
            names=["at", "total", "there"],
        )

    parts = x.select("x").mapInArrow(summed, "at int, total long, there long")
    found = {r["at"]: r for r in parts.groupBy("at").agg(F.sum("total").alias("total"), F.sum("there").alias("there")).collect()}
    n = int(found[-1]["there"]) if found else 0
    at = range(len(found) - 1 if found else 0)
    return n, np.array([found[j]["total"] + (n - found[j]["there"]) * offset for j in at], dtype=np.int64)


def covariance(x: DataFrame, n: int, sums: np.ndarray, offset: int) -> np.ndarray:
    """The covariance with divisor ``n``; every product is of centred numbers."""
    width = len(sums)
    rows, columns = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for _, values in matrices(batches, width, offset):
            centred = (n * values - sums) / n
            total += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array(columns, pa.int32()), pa.array(total[rows, columns])], names=["i", "j", "v"]
        )

    parts = x.select("x").mapInArrow(products, "i int, j int, v double")
    v = np.zeros((width, width))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        v[r["i"], r["j"]] = v[r["j"], r["i"]] = r["v"] / n
    return v


def fit(x: DataFrame, wanted: int, offset: int) -> Whitening:
    n, sums = dimension_sums(x, offset)
    v = covariance(x, n, sums, offset) if len(sums) else np.zeros((0, 0))
    values, found = components(v, wanted)
    return Whitening(n, sums, values, found, float(np.trace(v)), offset)


def whitened(x: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened): the squared distance of n * x from the sums, exact, and the whitened components."""
    n, sums, weights, offset = model.n, model.sums, model.weights(), model.offset

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in matrices(batches, len(sums), offset):
            centred = n * values - sums
            if float((centred.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) < 2**62:
                squares = [Decimal(s) for s in (centred**2).sum(axis=1).tolist()]
            else:
                squares = [Decimal(s) for s in (centred.astype(object) ** 2).sum(axis=1)]
            projected = (centred / n) @ weights
            ends = np.arange(0, projected.size + 1, weights.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("id")),
                    pa.array(squares, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(projected).ravel())),
                ],
                names=["id", "deviation", "whitened"],
            )

    return x.mapInArrow(work, "id long, deviation decimal(38,0), whitened array<double>")


def identity_error(rows: DataFrame, width: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` less the identity, 0.0 without rows."""
    part = [F.get("whitened", F.lit(k)) for k in range(width)]
    means = rows.agg(*(F.avg(c) for c in part)).first() if width else [None]
    if means[0] is None:
        return 0.0
    pairs = [(a, b) for a in range(width) for b in range(a, width)]
    found = rows.agg(*(F.avg((part[a] - means[a]) * (part[b] - means[b])) for a, b in pairs)).first()
    return max(abs(c - (a == b)) for c, (a, b) in zip(found, pairs, strict=True))


def whiten(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", wanted: int = 8, scale: int = 1024, offset: int = 100_000
) -> DataFrame:
    """One row for each usable row and component: see the module."""
    x = integers(df, key, vector, scale, offset)
    model = fit(x, wanted, offset)
    count = len(model.values)
    rows = written(whitened(x, model), "whitened") if count else x.limit(0).select(
        "id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened")
    )
    error = identity_error(rows, count)
    explained = F.array(*map(F.lit, model.explained)).cast("array<double>")
    each = rows.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        F.col("id").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
