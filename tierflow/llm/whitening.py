"""Whitening of embeddings on the leading eigenvectors of their covariance, found by spectrum slicing.

Vectors become whole numbers, so their sums are exact; the covariance is summed in the
tasks from centred rows, and only its d x d entries reach the driver. There, the number
of positive pivots of an LDL' factorisation of V - s I is the number of
eigenvalues above s (Sylvester's law of inertia). Bisection on these counts isolates
each leading eigenvalue, Rayleigh quotient iteration then converges to it cubically,
and two more counts, just below and just above the result, certify its number.

One factorisation costs d^3 / 3 operations on the driver, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, StructField, StructType

from tierflow.llm.storage import written

SCALE, SHIFT = 1024, 100_000
# Entries beyond this size have no exact whole numbers here and count as non-finite.
LARGEST = 2.0**51
BLOCK_ROWS = 4096
_X = "_tf_x"


def scaled(vector: str) -> Column:
    """floor(1024 * c) + 100000 of each entry c, as double; null if the vector or an entry is null or not finite."""
    c = F.col(vector)
    good = F.forall(c, lambda e: F.coalesce(F.abs(e.cast("double")) <= LARGEST, F.lit(False)))
    return F.when(good, F.transform(c, lambda e: F.floor(e.cast("double") * SCALE) + SHIFT))


# ------------------------------------------------------------------ sums in the tasks


def _matrices(batches, column: str, d: int):
    """Blocks of rows of an array column as numpy matrices."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index(column))
        flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for at in range(0, len(flat), BLOCK_ROWS):
            yield flat[at : at + BLOCK_ROWS]


def _whole_sums(batches, column: str, d: int):
    """(at, n, high, low): sums of whole numbers x = high * 2**31 + low, exact for 2**31 rows a task."""
    n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
    for x in _matrices(batches, column, d):
        n += len(x)
        high += (x >> 31).sum(axis=0)
        low += (x & ((1 << 31) - 1)).sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)], ["at", "n", "high", "low"])


def _real_sums(batches, column: str, d: int):
    n, total = 0, np.zeros(d)
    for x in _matrices(batches, column, d):
        n += len(x)
        total += x.sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(total)], ["at", "n", "total"])


def _products(batches, column: str, whole: np.ndarray, part: np.ndarray):
    """(i, row): rows of the sum of outer products of the centred vectors."""
    d = len(part)
    total = np.zeros((d, d))
    for x in _matrices(batches, column, d):
        y = (x - whole).astype(np.float64) - part
        total += y.T @ y
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])


def _covariance(rows: DataFrame, column: str, n: int, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Covariance with divisor n, centred on whole + part before multiplying; d x d numbers reach the driver."""
    partial = rows.select(column).mapInArrow(lambda batches: _products(batches, column, whole, part), "i long, row array<double>")
    entries = partial.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((len(part), len(part)))
    for r in entries.collect():
        out[r.i, r.j] = r.v
    return (out + out.T) / (2 * n)


# ------------------------------------------------------------------ spectrum slicing


def count_above(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of v above shift: positive pivots of LDL' of v - shift I (Bunch-Kaufman pivoting)."""
    a = v - shift * np.eye(len(v))
    n, k, above = len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        two = False
        if k + 1 < n:
            column = np.abs(a[k + 1 :, k])
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
            if most > 0 and abs(a[k, k]) < alpha * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                widest = row.max()
                if abs(a[k, k]) * widest < alpha * most * most:
                    if abs(a[r, r]) >= alpha * widest:
                        swap(k, r)
                    else:
                        swap(k + 1, r)
                        two = True
        if two:
            block, c = a[k : k + 2, k : k + 2].copy(), a[k + 2 :, k : k + 2].copy()
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            above += 1 if det < 0 else 2 * int(block[0, 0] + block[1, 1] > 0)
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(block, c.T)
            k += 2
        else:
            pivot, c = a[k, k], a[k + 1 :, k].copy()
            above += int(pivot > 0)
            if pivot:
                a[k + 1 :, k + 1 :] -= np.outer(c, c / pivot)
            k += 1
    return above


def _solved(v: np.ndarray, shift: float, b: np.ndarray, tolerance: float) -> np.ndarray:
    try:
        return np.linalg.solve(v - shift * np.eye(len(v)), b)
    except np.linalg.LinAlgError:  # an exact eigenvalue
        return np.linalg.solve(v - (shift + tolerance) * np.eye(len(v)), b)


def _away(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray | None:
    """x without its parts along found vectors, of length one; None if nothing is left."""
    for _ in range(2):
        for q in found:
            x = x - (q @ x) * q
    size = np.linalg.norm(x)
    return x / size if size > 0 and np.isfinite(size) else None


def leading_eigen(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors as columns, tolerance) of the k largest eigenvalues, falling.

    Eigenvalues that differ by less than the tolerance (rounding of v) are one cluster:
    its vectors are some orthonormal basis.
    """
    d = len(v)
    radius = np.abs(v).sum(axis=1)
    tolerance = 16 * d * np.finfo(float).eps * float(radius.max(initial=0.0))
    if tolerance == 0:
        return np.zeros(k), np.eye(d)[:, :k], 0.0
    edge = float(radius.max()) + tolerance
    counts = {-edge: d, edge: 0}
    start = np.random.default_rng(11)
    values: list[float] = []
    found: list[np.ndarray] = []
    for j in range(1, k + 1):
        while True:
            low = max(s for s, c in counts.items() if c >= j)
            high = min(s for s, c in counts.items() if c < j)
            middle = (low + high) / 2
            cluster = high - low <= tolerance or not low < middle < high
            if cluster or (counts[low] == j and counts[high] == j - 1):
                x = _away(start.standard_normal(d), found)
                for _ in range(3):
                    x = _away(_solved(v, middle, x, tolerance), found)
                value = float(x @ v @ x)
                for _ in range(12):
                    if np.linalg.norm(v @ x - value * x) <= tolerance:
                        break
                    if (closer := _away(_solved(v, value, x, tolerance), found)) is None:
                        break
                    x, value = closer, float(closer @ v @ closer)
                inside = low - tolerance <= value <= high + tolerance
                if inside and count_above(v, value - 4 * tolerance) >= j and count_above(v, value + 4 * tolerance) < j:
                    break
                if cluster:
                    raise ArithmeticError(f"eigenvalue {j} could not be certified")
            counts[middle] = count_above(v, middle)
        values.append(value)
        found.append(x)
    return np.array(values), np.stack(found, axis=1), tolerance


# ------------------------------------------------------------------ whitening


def _whitened(batches, names: list[str], n: int, whole: np.ndarray, rest: np.ndarray, axes: np.ndarray):
    """The carried columns, the exact deviation and the whitened values of each row."""
    d, k = axes.shape
    part = rest / n
    for batch in batches:
        x = batch.column(batch.schema.get_field_index(_X)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        z = x - whole
        most = n * (int(np.abs(z).max(initial=0)) + 1)
        if d * most * most < 1 << 63:
            t = n * z - rest
            squares = (t * t).sum(axis=1).tolist()
        else:
            t = z.astype(object) * n - rest.astype(object)
            squares = (t * t).sum(axis=1).tolist()
        exact = pa.array([Decimal(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
        w = (z.astype(np.float64) - part) @ axes
        flat = pa.array(w.ravel(), mask=np.isnan(w).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(w) * k + 1, k, dtype=np.int32)), flat)
        kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
        yield pa.RecordBatch.from_arrays([*kept, exact, lists], [*names, "deviation", "whitened"])


def whiten(vectors: DataFrame, x_col: str, *, components: int = 8, carry: Sequence[str] = ()) -> DataFrame:
    """carry, n, deviation, whitened, explained, identity_error of every whole-number vector.

    ``x_col`` is array<bigint> (``scaled`` makes it); rows where it is null take no part,
    nor do rows of another length than the most frequent one (ties: the longer).
    ``whitened`` holds min(components, length) values: the centred vector along each
    component over the root of its eigenvalue, null where the eigenvalue is zero up to
    rounding (constant columns, one row, equal rows). ``explained`` is the eigenvalue
    over the trace (null if that is zero). ``deviation`` is the exact sum of (n x - S)^2
    as decimal(38,0), null beyond. ``identity_error`` is measured on the whitened rows
    (null if no component has any variance). Repeated rows count each time; an empty
    table gives no rows. ``carry`` columns must not have the names of the results.
    """
    carry = list(carry)
    rows = written(vectors.where(F.col(x_col).isNotNull()).select(*carry, F.col(x_col).cast("array<bigint>").alias(_X)), "whitening_rows")
    sizes = rows.groupBy(F.size(_X).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    kept = StructType([rows.schema[c] for c in carry])
    schema = StructType([*kept.fields, StructField("deviation", DecimalType(38, 0)), StructField("whitened", ArrayType(DoubleType()))])
    if not d:
        none = rows.where("false").select(*carry, F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
        return _with_totals(none, carry, 0, F.lit(None).cast("array<double>"), None)
    rows = rows.where(F.size(_X) == d)
    partial = rows.select(_X).mapInArrow(lambda batches: _whole_sums(batches, _X, d), "at long, n long, high long, low long")
    totals = partial.groupBy("at").agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    found = {r.at: r for r in totals.collect()}
    n = found[0].n
    sums = [int(found[i].high) * (1 << 31) + int(found[i].low) for i in range(d)]
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    v = _covariance(rows, _X, n, whole, rest / n)

    k = min(components, d)
    values, axes, tolerance = leading_eigen(v, k)
    varied = values > tolerance
    axes = axes / np.sqrt(np.where(varied, values, np.nan))
    done = rows.mapInArrow(lambda batches: _whitened(batches, carry, n, whole, rest, axes), schema)
    done = written(done, "whitened")

    error, m = None, int(varied.sum())
    if m:  # eigenvalues fall, so those without variance come last
        w = done.select(F.slice("whitened", 1, m).alias("w"))
        means = w.mapInArrow(lambda batches: _real_sums(batches, "w", m), "at long, n long, total double").groupBy("at").agg(F.sum("total").alias("t"))
        mean = np.zeros(m)
        for r in means.collect():
            mean[r.at] = r.t / n
        error = float(np.abs(_covariance(w, "w", n, np.zeros(m), mean) - np.eye(m)).max())
    trace = float(np.trace(v))
    shares = [max(float(e), 0.0) / trace if trace > 0 else None for e in values]
    return _with_totals(done, carry, n, F.array(*[F.lit(s).cast("double") for s in shares]), error)


def _with_totals(rows: DataFrame, carry: list[str], n: int, explained: Column, error: float | None) -> DataFrame:
    return rows.select(
        *carry,
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
