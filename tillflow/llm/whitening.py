"""Whitening of embeddings by their leading principal components.

Sums, covariance and projection are passes over the table; only matrices of the vectors' dimension reach the driver.
Entries become integers, so sums and deviations are exact, and every row is centred before it is multiplied.

The spectrum of the covariance is sliced: the negative pivots of an LDL' factorisation of ``V - s`` count the
eigenvalues below ``s``, so bisection on ``s`` isolates each leading eigenvalue in an interval that holds no other.
Inside it Rayleigh quotient iteration converges cubically; counts just below and above the result certify that it is
the k-th largest. Eigenvalues that no interval separates, i.e. equal to rounding, are taken together as one space.

Defined cases: rows whose vector is NULL, or holds NULL, non-finite entries or entries too large for a long, are
dropped, and so are vectors of another length than the most frequent one (the longest of those); components whose
eigenvalue is zero to rounding are left out, as they cannot be whitened, so equal vectors, a single vector and an
empty table give no rows; a deviation beyond a long is NULL; repeated rows and ids count and return as often as they
stand there, missing ids too; columns other than id and vector are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000

# Numbers that one step inside a task holds as doubles.
CHUNK_CELLS = 1 << 20


@dataclass(frozen=True)
class Fit:
    """``n`` vectors with exact sums; eigenvalues (falling) and unit eigenvectors (columns) of their covariance."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray


# --- spectrum slicing ----------------------------------------------------------------------------


def count_below(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix lie below ``shift``: the negative pivots of LDL' of the shifted one.

    Pivots are of one or two rows (Bunch and Kaufman); by their choice one of two rows has one negative eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    alpha, negative, k, d = (1 + 17**0.5) / 8, 0, 0, len(a)
    while k < d:
        width = 1
        if k + 1 < d:
            column = np.abs(a[k + 1:, k])
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
            if abs(a[k, k]) < alpha * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if abs(a[k, k]) * other < alpha * most * most:
                    if abs(a[r, r]) >= alpha * other:
                        a[[k, r]] = a[[r, k]]
                        a[:, [k, r]] = a[:, [r, k]]
                    else:
                        width = 2
                        a[[k + 1, r]] = a[[r, k + 1]]
                        a[:, [k + 1, r]] = a[:, [r, k + 1]]
        rest, pivot = slice(k + width, d), a[k:k + width, k:k + width]
        if width == 2:
            negative += 1
            factor = np.linalg.solve(pivot, a[k:k + 2, rest])
            a[rest, rest] -= a[rest, k:k + 2] @ factor
        else:
            # A pivot of zero: the shift is an eigenvalue to rounding, which counts as not below.
            negative += pivot[0, 0] < 0
            if pivot[0, 0] != 0:
                a[rest, rest] -= np.outer(a[rest, k], a[k, rest] / pivot[0, 0])
        k += width
    return negative


def _solved(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.solve(a + np.eye(len(a)) * np.finfo(float).eps * (np.abs(a).sum(axis=1).max() or 1.0), b)


def _rayleigh(matrix: np.ndarray, shift: float, start: np.ndarray, tolerance: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from one step of inverse iteration at ``shift``."""
    identity, x = np.eye(len(matrix)), start
    for _ in range(30):
        x = _solved(matrix - shift * identity, x)
        x /= np.linalg.norm(x)
        shift = x @ matrix @ x
        if np.linalg.norm(matrix @ x - shift * x) <= tolerance:
            break
    return shift, x


def _space(matrix: np.ndarray, at: float, wanted: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of a group of ``wanted`` equal eigenvalues at ``at``, by inverse iteration on a whole block."""
    d = len(matrix)
    block = np.random.default_rng(5).standard_normal((d, wanted))
    near = matrix - (at + 1e-13 * np.abs(matrix).sum(axis=1).max()) * np.eye(d)
    for _ in range(4):
        block = _solved(near, block)
        block -= others @ (others.T @ block)
        block = np.linalg.qr(block)[0]
    return np.array([x @ matrix @ x for x in block.T]), block


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``wanted`` eigenvalues that are not zero to rounding, falling, and their unit eigenvectors as columns."""
    d = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not scale:
        return np.empty(0), np.empty((d, 0))
    # Everything is done on a matrix of norm one at most; counts at the ends are known.
    a = matrix / scale
    tiny = 4 * d * np.finfo(float).eps
    counts = {-1.0 - tiny: 0, 1.0 + tiny: d}

    def below(s: float) -> int:
        if s not in counts:
            counts[s] = count_below(a, s)
        return counts[s]

    positive = d - below(tiny)
    values, vectors, draw = [], np.empty((d, 0)), np.random.default_rng(7)
    while len(values) < min(wanted, positive):
        rank = d - len(values)  # the next eigenvalue is the rank-th from below
        low = max(s for s, c in counts.items() if c < rank)
        high = min(s for s, c in counts.items() if c >= rank)
        found = None
        while found is None:
            alone = below(high) - below(low) == 1
            if alone or high - low <= tiny:
                if alone:
                    value, x = _rayleigh(a, (low + high) / 2, draw.standard_normal(d), tiny)
                    # Certified: one eigenvalue, the rank-th, lies within rounding of the quotient.
                    inside = low - tiny <= value <= high + tiny
                    if inside and below(value - 2 * tiny) < rank <= below(value + 2 * tiny):
                        found = np.array([value]), x[:, None]
                        break
                if high - low <= tiny:
                    members = below(high) - below(low)
                    found = _space(a, (low + high) / 2, members, vectors)
                    break
            middle = (low + high) / 2
            if below(middle) < rank:
                low = middle
            else:
                high = middle
        # Vectors of close eigenvalues are only as orthogonal as their distance allows; the earlier ones stand.
        fresh = found[1] - vectors @ (vectors.T @ found[1])
        values.extend(found[0])
        vectors = np.hstack([vectors, fresh / np.linalg.norm(fresh, axis=0)])
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order] * scale, vectors[:, order]


# --- passes over the table -----------------------------------------------------------------------


def _usable(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x): the integer vectors of the rows that count."""
    limit = float(2**62 // SCALE)
    numbers = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    bad = F.exists(numbers, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= limit))
    rows = df.where(F.col(f"`{vector}`").isNotNull() & ~bad).select(F.col(f"`{id}`").alias("id"), F.transform(
        numbers, lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    length = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return rows.where(F.size("x") == (length.length if length else 0))


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d)


def _summed(d: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, d)
            n += len(x)
            # Halves of 31 bits keep the sums of a batch inside a long.
            high, low = (x >> 31).sum(axis=0).tolist(), (x & (2**31 - 1)).sum(axis=0).tolist()
            sums = [s + (h << 31) + l for s, h, l in zip(sums, high, low, strict=True)]
        if n:
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(range(d + 1), pa.int32()), "total": pa.array([str(v) for v in [n, *sums]], pa.string())})

    return add


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: in longs where they suffice, else in Python numbers."""
    if len(x) and max(abs(int(x.max())), abs(int(x.min())), 1) * n < 2**62 and max(map(abs, sums.tolist()), default=0) < 2**62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _multiplied(n: int, sums: np.ndarray, d: int):
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros((d, d)), False
        step = max(CHUNK_CELLS // d, 1)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                centred = _deviations(_matrix(batch.slice(at, step), d), n, sums).astype(float) / n
                total += centred.T @ centred
                any_row = True
        if any_row:
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(range(d), pa.int32()), "products": pa.array(list(total), pa.list_(pa.float64()))})

    return multiply


def _projected(fit: Fit):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, onto = len(fit.sums), fit.vectors / np.sqrt(fit.values)
        step = max(CHUNK_CELLS // d, 1)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                moved = _deviations(_matrix(part, d), fit.n, fit.sums)
                white = (moved.astype(float) / fit.n) @ onto
                if moved.dtype != object and (moved.astype(float) ** 2).sum(axis=1).max(initial=0) < 2**62:
                    squares = (moved * moved).sum(axis=1).tolist()
                else:
                    squares = [sum(int(v) ** 2 for v in row) for row in moved]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s if s < 2**63 else None for s in squares], pa.int64()),
                     pa.array(list(white), pa.list_(pa.float64()))], ["id", "deviation", "white"])

    return project


def fit_components(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit of (id, x) rows of one length; None if there are none or all are equal."""
    first = rows.select(F.size("x").alias("d")).first()
    d = first.d if first else 0
    if not d:
        return None
    totals = rows.select("x").mapInArrow(_summed(d), "place int, total string").groupBy("place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("place").collect()
    n, sums = int(totals[0].total), np.array([int(t.total) for t in totals[1:]], dtype=object)
    products = rows.select("x").mapInArrow(_multiplied(n, sums, d), "row int, products array<double>").select(
        "row", F.posexplode("products").alias("column", "product")).groupBy("row", "column").agg(F.sum("product").alias("s"))
    matrix = np.zeros((d, d))
    for r in products.collect():  # one number per pair of dimensions
        matrix[r.row, r.column] = r.s / n
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading_pairs(matrix, components)
    return Fit(n, sums, float(np.trace(matrix)), values, vectors) if len(values) else None


def whiten(df: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, n, deviation, white, shares, identity_error) per usable row: ``white`` holds its whitened coordinates,
    ``shares`` each component's part of the total variance; ``identity_error`` is the largest entry by which the
    covariance of ``white`` over all rows differs from the identity."""
    rows = _usable(df, id, vector)
    schema = f"id {dict(df.dtypes)[id]}, deviation long, white array<double>"
    fit = fit_components(rows, components)
    if fit is None:
        empty = df.sparkSession.createDataFrame([], schema)
        return empty.select("id", F.lit(0).cast("long").alias("n"), "deviation", "white", F.col("white").alias("shares"),
                            F.lit(0.0).alias("identity_error"))
    stored = written(rows.mapInArrow(_projected(fit), schema), "white")
    k = len(fit.values)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    # covar_pop merges means and centred products.
    entries = stored.agg(*[F.covar_pop(F.col("white")[i], F.col("white")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(v - (i == j)) for v, (i, j) in zip(entries, pairs, strict=True))
    shares = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    return stored.select("id", F.lit(fit.n).cast("long").alias("n"), "deviation", "white", shares.alias("shares"),
                         F.lit(float(error)).alias("identity_error"))
