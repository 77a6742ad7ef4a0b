"""Whitening of embeddings: eigenvectors of their covariance, refined by matrix products.

Tasks add up centred products exactly, as whole numbers, so the covariance is known to the last bit. Its
eigenvectors are taken in float32 and corrected by the iteration of Ogita and Aishima, first in float64
and at last in extended precision; eigenvalues too close for a step are parted by solving the small
problem that they span. The driver holds matrices of the dimension's size only.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm.common import stored

SCALE = 256
_HELD = 1 << 60  # scaled entries are held within this
_LIMB = 21  # bits of a digit of the products: 2**42 times _ROWS stays below 2**53
_ROWS = 2048
_DIGIT = 40  # bits of a digit of the sums that tasks send
_SUMS = "place long, d0 long, d1 long, d2 long, d3 long"
_SHARE = 1 << 56  # unit of shares that are added as whole numbers


def scaled(vector: Column) -> Column:
    """floor(256 c) of every entry; null for a null vector and one with null or non-finite entries."""
    usable = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-float(_HELD)), F.least(F.lit(float(_HELD)), c.cast("double") * SCALE))))
    return F.when(usable, whole)


def usable_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the rows that remain."""
    kept = rows.select(F.col(id_col).alias("id"), scaled(F.col(vector_col)).alias("x")).filter(F.col("x").isNotNull())
    lengths = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return kept.filter(F.size("x") == (usual.d if usual else 0))


def _matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    """Digits of ``_LIMB`` bits as float64, the last one signed; one digit where that holds the numbers."""
    out = []
    while len(x) and np.abs(x).max() >= 1 << _LIMB:
        out.append((x & ((1 << _LIMB) - 1)).astype(np.float64))
        x = x >> _LIMB
    return [*out, x.astype(np.float64)]


def _digits(values: list[int]) -> pa.RecordBatch:
    """Whole numbers of up to 160 bits as rows of digits that can be added natively."""
    mask = (1 << _DIGIT) - 1
    columns = [pa.array(range(len(values)), pa.int64())]
    columns += [pa.array([v >> (_DIGIT * k) & mask for v in values], pa.int64()) for k in range(3)]
    columns.append(pa.array([v >> (_DIGIT * 3) for v in values], pa.int64()))
    return pa.RecordBatch.from_arrays(columns, names=["place", "d0", "d1", "d2", "d3"])


def _added(parts: DataFrame, size: int) -> list[int]:
    """Sums by place, of which there are ``size``."""
    digits = [f"d{k}" for k in range(4)]
    rows = parts.groupBy("place").agg(*[F.sum(c).alias(c) for c in digits]).collect()
    out = [0] * size
    for r in rows:
        out[r.place] = sum(r[c] << (_DIGIT * k) for k, c in enumerate(digits))
    return out


def _sums(d: int):
    """Rows, and the sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            for k in range(0, len(x), _ROWS):
                for j, limb in enumerate(_limbs(x[k : k + _ROWS])):
                    total = [a + (int(b) << (_LIMB * j)) for a, b in zip(total, limb.sum(axis=0).tolist(), strict=True)]
            n += len(x)
        yield _digits([n, *total])

    return run


def _products(d: int, shift: list[int]):
    """Sums of the products of every two dimensions, ``shift`` being taken off before."""
    at = np.array(shift, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}  # by the power of two that stands before the sum
        for batch in batches:
            x = _matrix(batch.column("x"), d) - at
            for k in range(0, len(x), _ROWS):
                limbs = _limbs(x[k : k + _ROWS])
                for i, a in enumerate(limbs):
                    for j, b in enumerate(limbs):
                        power = _LIMB * (i + j)
                        part = np.vectorize(int, otypes=[object])(a.T @ b) if power else (a.T @ b).astype(np.int64)
                        kept[power] = kept[power] + part if power in kept else part
        if kept:
            whole = sum(part.astype(object) * (1 << power) for power, part in kept.items())
            yield _digits([int(v) for v in whole.ravel()])

    return run


def covariance(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[Fraction]]]:
    """(n, sums, covariance) of the rows ``x`` of ``fit``, exactly, divisor n.

    Whole numbers next to the means are taken off before multiplying; what then remains of the means is
    taken off exactly.
    """
    n, *total = _added(fit.select("x").mapInArrow(_sums(d), _SUMS), d + 1)
    if not n:
        return 0, total, []
    shift = [(2 * s + n) // (2 * n) for s in total]
    products = _added(fit.select("x").mapInArrow(_products(d, shift), _SUMS), d * d)
    rest = [s - n * m for s, m in zip(total, shift, strict=True)]
    exact = [[Fraction(n * products[i * d + j] - rest[i] * rest[j], n * n) for j in range(d)] for i in range(d)]
    return n, total, exact


def _clusters(values: np.ndarray, least: float) -> list[np.ndarray]:
    """Numbers of eigenvalues with a neighbour nearer than ``least``, in groups."""
    order = np.argsort(values, kind="stable")
    near = np.diff(values[order]) <= least
    parts = np.split(order, np.flatnonzero(~near) + 1)
    return [p for p in parts if len(p) > 1]


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step for all eigenvectors at once: (vectors, eigenvalues, greatest correction)."""
    d = len(a)
    eye = np.eye(d, dtype=a.dtype)

    def measured(x):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        least = 2 * (np.linalg.norm(off.astype(np.float64)) + np.linalg.norm(a.astype(np.float64)) * np.linalg.norm(r.astype(np.float64)))
        return r, s, values, least

    r, s, values, least = measured(x)
    groups = _clusters(values, least)
    for group in groups:
        basis = x[:, group]
        inner = basis.T @ (a @ basis) - np.mean(values[group]) * (basis.T @ basis)  # what sets them apart
        inner = (inner + inner.T) / 2
        size = np.abs(inner).max()
        if size > 0:
            x[:, group] = basis @ np.linalg.eigh((inner / size).astype(np.float64))[1].astype(a.dtype)
    if groups:
        r, s, values, least = measured(x)
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > least
    fix = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ fix, values, float(np.abs(fix).max())


def refined_eigenvectors(a: np.ndarray, rounds: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors in columns) of a symmetric matrix in extended precision, falling."""
    size = np.abs(a).max()
    if not size > 0:
        return np.zeros(len(a), a.dtype), np.eye(len(a), dtype=a.dtype)
    unit = (a / size).astype(np.longdouble)
    x = np.linalg.eigh(unit.astype(np.float32))[1]
    for kind, enough in ((np.float64, 1e-12), (np.longdouble, 1e-17)):
        x = x.astype(kind)
        for _ in range(rounds):
            x, values, change = _step(unit.astype(kind), x)
            if change < enough:
                break
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    most = np.abs(x).argmax(axis=0)
    return values[order] * size, x * np.sign(x[most, np.arange(len(x))])


def _extended(exact: list[list[Fraction]]) -> np.ndarray:
    high = np.array([[float(v) for v in row] for row in exact])
    low = np.array([[float(v - Fraction(h)) for v, h in zip(row, hs, strict=True)] for row, hs in zip(exact, high.tolist(), strict=True)])
    return high.astype(np.longdouble) + low


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n x - S, in Python's whole numbers where 64 bits may not do."""
    bound = n * int(np.abs(x).max(initial=0)) + max(map(abs, total), default=0)
    if bound < 1 << 62:
        return n * x - np.array(total, np.int64)
    return x.astype(object) * n - np.array(total, object)


def _whitener(n: int, total: list[int], vectors: np.ndarray):
    def whiten(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = _centred(x, n, total)
        return apart, (apart.astype(np.float64) / n) @ vectors

    return whiten


def _shares(d: int, n: int, whiten):
    """Sums of whitened values and of their products over n, as whole numbers so that their order is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = 0.0
        for batch in batches:
            y = whiten(_matrix(batch.column("x"), d))[1]
            y1 = np.column_stack([np.ones(len(y)), y])
            found = found + y1.T @ y1
        if not isinstance(found, float):
            yield _digits([round(float(v) / n * _SHARE) for v in found.ravel()])

    return run


def _output(d: int, n: int, whiten, explained: list[float], error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = len(explained)
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            apart, y = whiten(x)
            bound = d * int(np.abs(apart).max(initial=0)) ** 2
            square = (apart if bound < 1 << 63 else apart.astype(object)) ** 2
            deviation = [v if v < 1 << 63 else None for v in square.sum(axis=1).tolist()]
            rows = np.repeat(np.arange(len(x)), c)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(rows), n)), pa.array([v for v in deviation for _ in range(c)], pa.int64()),
                 pa.array(y.ravel()), pa.array(np.tile(np.array(explained, np.float64), len(x))),
                 pa.array(np.full(len(rows), error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whitened_vectors(
    rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4
) -> DataFrame:
    """Each remaining row's whitened values, one row for each of the first ``components`` components.

    Rows whose vector is null or holds null or non-finite entries go, as do those of another length than
    the most frequent one (of equally frequent ones, the longest). Entries become floor(256 c), held within
    2**60. The covariance is that of each distinct vector once. Returns: id, ``component`` (by falling
    eigenvalue, from 1; those with none but rounding left are left out), ``n`` (distinct vectors),
    ``deviation`` (exact sum of (n x - S)**2; null if above a long), ``whitened``, ``explained``,
    ``identity_error`` (greatest entry of the whitened covariance less the identity). Repeated rows get a
    result each, null ids are kept, other columns are not read; an empty table gives no rows.
    """
    kept = usable_vectors(rows, id_col, vector_col)
    fit = stored(kept.select("x").distinct(), "fit-vectors")
    one = fit.first()
    d = len(one.x) if one else 0
    schema = T.StructType([
        T.StructField("id", rows.schema[id_col].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    n, total, exact = covariance(fit, d) if d else (0, [], [])
    trace = sum(exact[i][i] for i in range(d)) if exact else Fraction(0)
    if not trace:  # nothing differs
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    values, vectors = refined_eigenvectors(_extended(exact))
    share = values / np.longdouble(float(trace))
    count = int((share[:components] > 1e-15).sum())
    whiten = _whitener(n, total, (vectors[:, :count] / np.sqrt(values[:count])).astype(np.float64))
    sums = _added(fit.mapInArrow(_shares(d, n, whiten), _SUMS), (count + 1) ** 2)
    found = np.array([v / _SHARE for v in sums]).reshape(count + 1, count + 1)
    error = float(np.abs(found[1:, 1:] - np.outer(found[0, 1:], found[0, 1:]) - np.eye(count)).max())
    explained = [float(v) for v in share[:count]]
    out = kept.mapInArrow(_output(d, n, whiten, explained, error), schema)
    return out.withColumnRenamed("id", id_col)
