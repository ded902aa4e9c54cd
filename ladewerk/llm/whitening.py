"""Whitening of embeddings: principal components of the covariance, each scaled to
variance one.

One pass gathers exact sums and a covariance whose batches are centred before they are
multiplied; partial results are merged by row of the matrix, so that a task holds one row
of every partition's. The matrix itself, of dimension times dimension doubles, is all that
reaches the driver, where contour integration (`feast`) finds the components. A second pass
takes the covariance of the whitened values, a third writes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladewerk.llm import feast

SCALE, SHIFT = 1024, 100_000
#: Entries of this size and beyond do not fit the integer grid.
LARGEST = float(1 << 52)
PARTIAL = "i int, n long, high long, low long, mean binary, row binary"
MERGED = "i int, n long, total string, row binary"


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size, exact sums per dimension, and components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def values_of(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S of each entry, exact; whitened values) of rows of grid numbers."""
        off = _exact(grid, self.n, self.sums)
        return off, (off.astype(float) / self.n) @ (self.vectors / np.sqrt(self.values))


def _exact(grid: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * grid - sums as int64, or as Python integers where that could overflow."""
    largest = max(map(abs, sums), default=0) + n * int(np.abs(grid).max(initial=0))
    if largest < 1 << 62:
        return grid * n - np.array(sums, np.int64)
    return grid.astype(object) * n - np.array(sums, object)


def _squares(off: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; None where it does not fit a long."""
    if off.dtype != object and off.size and float(np.abs(off).max()) ** 2 * off.shape[1] < 2.0**62:
        return (off * off).sum(axis=1).tolist()
    whole = off.astype(object)
    return [x if x < 1 << 63 else None for x in (whole * whole).sum(axis=1).tolist()] if off.size else []


def usable(vector: str | Column) -> Column:
    """Whether a vector takes part: not null or empty, and no entry null, not finite or
    beyond the grid (2^52)."""
    held = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(held.cast("array<double>"), lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)) & ~F.isnan(x))
    return F.coalesce(fine & (F.size(held) > 0), F.lit(False))


def _vectors(rows: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """(id, vector of doubles) of the usable rows of the commonest length (of equally
    common ones the smallest), and that length; 0 if there are none."""
    fine = rows.where(usable(vector)).select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    length = fine.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return (fine.where(F.size("vector") == length["d"]), length["d"]) if length else (fine, 0)


def _grid(column: pa.Array, d: int) -> np.ndarray:
    """floor(1024 * entry) + 100000 of each vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    return np.floor(SCALE * flat).astype(np.int64) + SHIFT


def _merge(a: tuple, b: tuple) -> tuple:
    """(n, mean, centred products) of two sets together; products may be whole matrices or
    some rows of them, whose own means are given too."""
    n, m = a[0], b[0]
    step, own = b[1] - a[1], b[3] - a[3]
    return n + m, a[1] + step * (m / (n + m)), a[2] + b[2] + np.multiply.outer(own, step) * (n * m / (n + m)), a[3] + own * (m / (n + m))


def _moments(numbers: DataFrame, make, d: int) -> list:
    """n, exact total and row of centred products (as bytes) of each of d dimensions.

    `make` turns an Arrow batch into rows of numbers, integers or doubles. Totals are those
    of integers; of doubles they are not used.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, high, low = None, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = make(batch)
            if x.dtype == np.int64:
                high, low = high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0)
            mean = x.mean(axis=0)
            off = x - mean
            here = (len(x), mean, off.T @ off, mean)
            held = here if held is None else _merge(held, here)
        if held is not None:
            names = [f.split()[0] for f in PARTIAL.split(", ")]
            columns = [
                pa.array(range(d), pa.int32()), pa.array([held[0]] * d, pa.int64()), pa.array(high), pa.array(low),
                pa.array([held[1].tobytes()] * d, pa.binary()), pa.array([r.tobytes() for r in held[2]], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def merged(group: pa.Table) -> pa.Table:
        i, held, total = group.column("i")[0].as_py(), None, 0
        # In an order of content, so that it does not matter in which order tasks ended.
        for n, high, low, mean, row in sorted(zip(*(group.column(c).to_pylist() for c in ("n", "high", "low", "mean", "row")), strict=True)):
            mean, row = np.frombuffer(mean), np.frombuffer(row)
            total += (high << 31) + low
            here = (n, mean, row, mean[i])
            held = here if held is None else _merge(held, here)
        return pa.table({"i": pa.array([i], pa.int32()), "n": pa.array([held[0]], pa.int64()), "total": [str(total)], "row": pa.array([held[2].tobytes()], pa.binary())})

    return numbers.mapInArrow(partial, PARTIAL).groupBy("i").applyInArrow(merged, MERGED).orderBy("i").collect()


def fit(vectors: DataFrame, d: int, components: int = 8) -> Whitening:
    """Components of all rows of (id, vector of d doubles)."""
    rows = _moments(vectors.select("vector"), lambda b: _grid(b.column(0), d), d) if d else []
    if not rows:
        return Whitening(0, [0] * d, np.empty(0), np.empty((d, 0)), 0.0)
    n = rows[0]["n"]
    covariance = np.stack([np.frombuffer(r["row"]) for r in rows]) / n
    covariance = (covariance + covariance.T) / 2
    values, basis = feast.leading(covariance, components)
    return Whitening(n, [int(r["total"]) for r in rows], values, basis, float(np.trace(covariance)))


def identity_error(vectors: DataFrame, d: int, model: Whitening) -> float:
    """How far the covariance of the whitened values is from the identity, at most."""
    k = len(model.values)
    rows = _moments(vectors.select("vector"), lambda b: model.values_of(_grid(b.column(0), d))[1], k) if k else []
    if not rows:
        return 0.0
    return float(np.abs(np.stack([np.frombuffer(r["row"]) for r in rows]) / model.n - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = 8, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, component (from 1, by falling
    eigenvalue), n, deviation, whitened, explained, identity_error.

    An entry c counts as floor(1024 * c) + 100000. Vectors that are null, empty or hold
    entries that are null, not finite or from 2^52 on take no part; nor do those whose
    length is not the commonest one. Rows that repeat an id or a vector each count; a null
    id is kept. A component whose eigenvalue is not above rounding has nothing to scale, so
    data of a low rank (or a single row, or equal rows) have fewer components or none. A
    deviation that does not fit a long is null. Other columns are not read, and an empty
    table gives no rows.
    """
    vectors, d = _vectors(rows, id_column, vector)
    model = fit(vectors, d, components)
    error = identity_error(vectors, d, model)
    k = len(model.values)
    explained = model.values / model.trace if k else model.values
    names = [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            off, white = model.values_of(_grid(batch.column(1), d))
            owner = np.repeat(np.arange(batch.num_rows), k)
            out = [
                batch.column(0).take(pa.array(owner)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(len(owner), model.n)), pa.array(_squares(off), pa.int64()).take(pa.array(owner)),
                pa.array(white.astype(float).ravel()), pa.array(np.tile(explained, batch.num_rows)), pa.array(np.full(len(owner), error)),
            ]
            yield pa.RecordBatch.from_arrays(out, names)

    return vectors.mapInArrow(write, schema)
