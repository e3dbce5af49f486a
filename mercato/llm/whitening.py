"""Whitening of embeddings by spectrum slicing (operator 12).

Vectors are scaled to integers, x = floor(scale * c) + offset, so that counts,
sums and second moments are exact and do not depend on how rows are spread.
Spark sums x per dimension, then the products of x less the rounded mean (a
matrix per task, then one row per dimension and task); the covariance, divisor
n, follows from those sums without cancellation. Only sums of the size of one
covariance matrix reach the driver.

There, LDL^T factors of the covariance less a shift count the eigenvalues above
the shift (Sylvester's law of inertia). Bisection with these counts brings each
leading eigenvalue into an interval of its own; Rayleigh quotient iteration then
converges to it cubically, and counts on both sides of the value found certify
its number. Eigenvalues that no shift can tell apart in double precision stay
together; each of them gets a vector orthogonal to the others'.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries, or values whose integers have 52 bits or more, are left out, and so are vectors of
another length than most have (of equally frequent lengths the greater counts);
a component needs an eigenvalue clear of rounding (dimensions * 2**-50 of the
largest), so vectors that are all equal have no component; repeated rows count each; an empty table gives an
empty result. ``deviation`` is null where it does not fit a BIGINT. Only the
vector and the columns in ``keep`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import settled

SCALE, OFFSET, MOST = 64, 1_000_000, 32
_LIMIT = 1 << 52  # integers beyond are not exact in a double
_ROWS = 4096  # rows whose matrix product is taken at once
_BLOCK = (1 + 17**0.5) / 8  # Bunch and Kaufman's bound on the growth of pivots


# --- eigenvalues of a small matrix ------------------------------------------------------------------------------


def ldl_pivots(a: np.ndarray) -> tuple[int, int, int]:
    """How many eigenvalues of a symmetric matrix are positive, zero and negative, from the blocks of D in LDL^T
    (diagonal pivoting by Bunch and Kaufman)."""
    a = a.copy()
    n, k, signs = len(a), 0, [0, 0, 0]
    while k < n:
        below = np.abs(a[k + 1:, k])
        size = below.max() if len(below) else 0.0
        here, two = abs(a[k, k]), False
        if max(here, size) == 0:
            signs[1] += 1
            k += 1
            continue
        if here < _BLOCK * size:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = row.max()
            if here * other < _BLOCK * size * size:
                two = abs(a[r, r]) < _BLOCK * other
                to = k + 1 if two else k
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if two:
            d = a[k: k + 2, k: k + 2].copy()
            signs[0] += 1  # such a block has one eigenvalue of each sign
            signs[2] += 1
            left = a[k + 2:, k: k + 2]
            det = d[0, 0] * d[1, 1] - d[0, 1] * d[1, 0]
            factor = np.stack([left[:, 0] * d[1, 1] - left[:, 1] * d[1, 0], left[:, 1] * d[0, 0] - left[:, 0] * d[0, 1]], axis=1) / det
            a[k + 2:, k + 2:] -= factor @ left.T
            k += 2
        else:
            signs[0 if a[k, k] > 0 else 2] += 1
            left = a[k + 1:, k]
            a[k + 1:, k + 1:] -= np.outer(left / a[k, k], left)
            k += 1
    return signs[0], signs[1], signs[2]


def count_above(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``a`` are greater than ``shift``."""
    return ldl_pivots(a - shift * np.eye(len(a)))[0]


def leading_eigenpairs(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues (falling, ``most`` at most, those clear of rounding) and unit eigenvectors (rows)."""
    n = len(a)
    reach = float(np.abs(a).sum(axis=1).max()) if n else 0.0
    if not reach:
        return np.zeros(0), np.zeros((0, n))
    least, tight = n * 2.0**-50 * reach, 4 * n * 2.0**-53 * reach
    known = {-reach - tight: n, reach + tight: 0}  # eigenvalues above each shift tried
    # clear of rounding: above ``least`` of the largest eigenvalue, which is not far below ``reach``
    want = min(most, count_above(a, least))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < want:
        i = len(values)
        lo, hi = _bracket(known, i)
        while (known[lo], known[hi]) != (i + 1, i) and hi - lo > tight:
            lo, hi = _halved(a, known, i)
        if known[lo] - known[hi] > 1:  # as close as rounding allows: one after another, each orthogonal to the others
            for j in range(i, min(known[lo], want)):
                pair = _iterate(a, lo, hi, vectors, j, tight, 60)
                if pair is None:
                    raise ArithmeticError(f"no eigenvector to eigenvalue {j + 1}")
                values.append(pair[0])
                vectors.append(pair[1])
            continue
        while (pair := _iterate(a, lo, hi, vectors, i, tight, 12)) is None or not _certified(a, pair[0], i, tight):
            if hi - lo <= tight:
                raise ArithmeticError(f"no eigenvector to eigenvalue {i + 1}")
            lo, hi = _halved(a, known, i)  # a neighbour was nearer
        values.append(pair[0])
        vectors.append(pair[1])
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(len(values), n)[order]


def _bracket(known: dict[float, int], i: int) -> tuple[float, float]:
    """The closest shifts tried with eigenvalue number i (from 0) between them."""
    lo = max(s for s, above in known.items() if above > i)
    return lo, min(s for s, above in known.items() if above <= i and s > lo)


def _halved(a: np.ndarray, known: dict[float, int], i: int) -> tuple[float, float]:
    """The bracket after a count in its middle."""
    lo, hi = _bracket(known, i)
    middle = (lo + hi) / 2
    known[middle] = min(max(count_above(a, middle), known[hi]), known[lo])  # rounding cannot break the order
    return _bracket(known, i)


def _iterate(a: np.ndarray, lo: float, hi: float, found: list[np.ndarray], number: int, tight: float, steps: int) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from the middle of (lo, hi), orthogonal to the vectors found; None if it leads elsewhere."""
    n = len(a)
    others = np.array(found).reshape(len(found), n)

    def cleared(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - others.T @ (others @ v)
        return v / np.linalg.norm(v)

    v = cleared(np.random.default_rng(number).standard_normal(n))
    shift, best = (lo + hi) / 2, (np.inf, 0.0, v)
    for _ in range(steps):
        try:
            w = np.linalg.solve(a - shift * np.eye(n), v)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            w = np.linalg.solve(a - (shift + tight / 4) * np.eye(n), v)
        if not np.isfinite(w).all():
            break
        v = cleared(w)
        value = float(v @ (a @ v))
        miss = float(np.linalg.norm(a @ v - value * v))
        inside = lo - tight <= value <= hi + tight
        if inside and miss < best[0] / 2:
            best = (miss, value, v)
        elif best[0] <= 4 * tight:
            break
        shift = value if inside and miss < hi - lo else (lo + hi) / 2  # not near enough yet: inverse iteration
    if best[0] > 4 * tight:
        return None
    v = best[2] * np.sign(best[2][np.abs(best[2]).argmax()])
    return best[1], v


def _certified(a: np.ndarray, value: float, i: int, tight: float) -> bool:
    """Whether eigenvalue number i (from 0) lies within rounding of ``value``, by the counts on both sides."""
    return count_above(a, value + 4 * tight) <= i < count_above(a, value - 4 * tight)


# --- the fit, in Spark -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """n vectors with sums ``total``; components (rows of ``axes``) with eigenvalues ``values``; all of its size is that of a covariance."""

    n: int
    dims: int
    total: list[int]
    centre: np.ndarray  # the rounded means
    rest: np.ndarray  # means less those
    values: np.ndarray
    axes: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Integer vectors (rows) to components."""
        centred = (x - self.centre).astype(np.float64) - self.rest
        return centred @ self.axes.T / np.sqrt(self.values)


def _integers(column: pa.Array, scale: int, offset: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows have whole vectors, and their integers (still of any length)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = column.offsets.to_numpy()
    flat = np.asarray(column.values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)  # null is NaN
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(flat * scale) + offset
    good = np.abs(scaled) < _LIMIT
    bad = np.concatenate([[0], np.cumsum(~good)])
    valid = ~np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
    whole = valid & (at[1:] > at[:-1]) & (bad[at[1:]] == bad[at[:-1]])
    x = np.where(good, scaled, 0).astype(np.int64)
    return whole, [x[a:b] for a, b, w in zip(at[:-1].tolist(), at[1:].tolist(), whole.tolist(), strict=True) if w]


def _matrices(stream: Iterator[pa.RecordBatch], dims: int | None, scale: int, offset: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows whose vectors are whole and have ``dims`` entries, with those as a matrix, some thousand at a time."""
    for rows in stream:
        for i in range(0, rows.num_rows, _ROWS):
            part = rows.slice(i, _ROWS)
            whole, x = _integers(pa.concat_arrays([part.column(0)]), scale, offset)
            kept = np.flatnonzero(whole)
            if dims is not None:
                fits = [j for j, v in enumerate(x) if len(v) == dims]
                kept, x = kept[fits], [x[j] for j in fits]
            if len(kept):
                yield part.take(pa.array(kept)), x


def _sums(src: DataFrame, scale: int, offset: int) -> tuple[int, int, list[int]]:
    """Rows, dimensions and the sum per dimension, of the most frequent length."""

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for _, vectors in _matrices(stream, None, scale, offset):
            by_length: dict[int, list[np.ndarray]] = {}
            for v in vectors:
                by_length.setdefault(len(v), []).append(v)
            for d, own in by_length.items():
                n, total = held.get(d, (0, np.zeros(d, object)))
                held[d] = n + len(own), total + np.array(own).sum(axis=0).astype(object)  # Python integers from here on
        for d, (n, total) in held.items():
            for low in range(0, d, _ROWS):  # a row each for some dimensions
                cut = total[low: low + _ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(cut), pa.int32()), pa.array(range(low, low + len(cut)), pa.int32()), pa.array([n] * len(cut), pa.int64()),
                     pa.array([str(x) for x in cut], pa.string())], ["dims", "i", "n", "total"])

    parts = src.mapInArrow(work, "dims int, i int, n long, total string")
    parts = settled(parts.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")), "vector_sums")
    most = parts.where("i = 0").orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not most:
        return 0, 0, []
    rows = parts.where(F.col("dims") == most[0]["dims"]).select("i", "total").collect()
    return most[0]["n"], most[0]["dims"], [int(total) for _, total in sorted(rows)]


def _products(src: DataFrame, dims: int, centre: np.ndarray, scale: int, offset: int) -> list[list[int]]:
    """Row i of the sum of outer products of x - centre, exactly."""

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        held, bound = np.zeros((dims, dims)), 0.0  # doubles are exact below 2**53
        for _, vectors in _matrices(stream, dims, scale, offset):
            z = np.array(vectors) - centre
            for part in _exact_parts(z):
                grown = float(np.abs(part).max()) ** 2 * len(part)
                if bound + grown >= 2.0**53:
                    total, held, bound = total + held.astype(np.int64).astype(object), np.zeros((dims, dims)), 0.0
                if grown >= 2.0**53:  # wide numbers: with Python integers
                    total = total + part.astype(object).T @ part.astype(object)
                    continue
                held, bound = held + part.astype(np.float64).T @ part.astype(np.float64), bound + grown
        total = total + held.astype(np.int64).astype(object)
        for i in range(dims):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([[str(x) for x in total[i, i:]]], pa.list_(pa.string()))], ["i", "row"])

    parts = src.mapInArrow(work, "i int, row array<string>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    out = [[0] * dims for _ in range(dims)]
    for i, j, x in cells.collect():
        out[i][i + j] = out[i + j][i] = int(x)
    return out


def _exact_parts(z: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of the rows small enough for exact products in doubles, where that is possible."""
    most = float(np.abs(z).max()) if z.size else 0.0
    step = max(1, min(len(z), int(2.0**52 / max(most * most, 1.0))))
    for i in range(0, len(z), step):
        yield z[i: i + step]


def _source(table: DataFrame, vector: str, keep: dict[str, Column]) -> DataFrame:
    return table.select(F.col(f"`{vector}`").cast("array<double>").alias("__vector"), *[c.alias(n) for n, c in keep.items()])


def fit(table: DataFrame, most: int = MOST, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> Fit:
    """Covariance and leading components of all whole vectors."""
    src = _source(table, vector, {})
    n, dims, total = _sums(src, scale, offset)
    if not n:
        return Fit(0, 0, [], np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros((0, 0)), 0.0)
    centre = [(2 * s + n) // (2 * n) for s in total]  # means rounded to integers
    shifted = [s - n * c for s, c in zip(total, centre, strict=True)]
    cells = _products(src, dims, np.array(centre, np.int64), scale, offset)
    cov = np.array([[float(Fraction(n * cells[i][j] - shifted[i] * shifted[j], n * n)) for j in range(dims)] for i in range(dims)])
    trace = float(sum(Fraction(n * cells[i][i] - shifted[i] ** 2, n * n) for i in range(dims)))
    values, axes = leading_eigenpairs(cov, most)
    return Fit(n, dims, total, np.array(centre, np.int64), np.array([float(Fraction(t, n)) for t in shifted]), values, axes, trace)


def _deviations(found: Fit, x: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n * x - total) squared, exactly."""
    far = max((abs(int(v)) for v in (x - found.centre).ravel()), default=0) + 1
    if (found.n * far) ** 2 * found.dims < 1 << 63:
        gap = found.n * (x - found.centre) - np.array([s - found.n * int(c) for s, c in zip(found.total, found.centre, strict=True)], np.int64)
        return (gap * gap).sum(axis=1).tolist()
    out = []
    for row in x.tolist():
        exact = sum((found.n * v - s) ** 2 for v, s in zip(row, found.total, strict=True))
        out.append(exact if exact < 1 << 63 else None)
    return out


def whitened(table: DataFrame, found: Fit, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET, **keep: Column) -> DataFrame:
    """The columns in ``keep``, deviation and ``whitened`` (an entry per component) of every whole vector."""
    src = _source(table, vector, keep)
    schema = T.StructType([*src.schema.fields[1:], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    names = schema.names

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, vectors in _matrices(stream, found.dims, scale, offset):
            x = np.array(vectors)
            w = found.whiten(x)
            arrays = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(_deviations(found, x), pa.int64()), arrays], names)

    return src.mapInArrow(work, schema)


def identity_error(rows: DataFrame, found: Fit) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` less the identity; null without components."""
    k = len(found.values)
    if not k:
        return None

    def moments(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in stream:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            n, sums, products = n + len(w), sums + w.sum(axis=0), products + w.T @ w  # the vectors are centred already
        body = np.concatenate([[n], sums, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(body)), pa.int32()), pa.array(body)], ["i", "x"])

    cells = rows.select("whitened").mapInArrow(moments, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    body = np.zeros(1 + k + k * k)
    for i, x in cells:
        body[i] = x
    mean = body[1: 1 + k] / body[0]
    return float(np.abs(body[1 + k:].reshape(k, k) / body[0] - np.outer(mean, mean) - np.eye(k)).max())


def whiten(table: DataFrame, most: int = MOST, vector: str = "embedding", scale: int = SCALE, offset: int = OFFSET, **keep: Column) -> DataFrame:
    """One row per whole vector and component: the columns in ``keep``, component (from 1), n, deviation, whitened,
    explained (the component's share of the variance) and identity_error (one value)."""
    found = fit(table, most, vector, scale, offset)
    rows = whitened(table, found, vector, scale, offset, **keep)
    error = identity_error(rows, found)
    shares = [float(v / found.trace) for v in found.values]
    out = rows.select(*keep, "deviation", F.posexplode("whitened").alias("__i", "whitened"))
    share = F.element_at(F.array(*[F.lit(s) for s in shares]), F.col("__i") + 1) if shares else F.lit(None)
    return out.select(*keep, (F.col("__i") + 1).alias("component"), F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
                      share.cast("double").alias("explained"), F.lit(error).cast("double").alias("identity_error"))
