"""Whitening of embeddings by TSQR: no covariance is formed.

Entries become integers, so sums and deviations are exact. Each partition of the
different vectors centres its rows by the exact sums and keeps the R of their QR
only; the Rs are merged as a tree. The right singular vectors of the last R, a
square of the number of dimensions, whiten the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.llm.frames import Scratch, release

#: An entry c becomes floor(STEPS * c) + SHIFT; c beyond 2 ** 62 / STEPS counts as this.
STEPS, SHIFT, LARGEST = 64, 1_000_000, 1 << 62
#: Rows of a block in memory; parts that a node of the tree merges.
BLOCK, FAN = 4096, 16


def _finite(vector: Column) -> Column:
    """Whether there is a vector, and none of its entries is null, NaN or infinite."""
    fine = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine), F.lit(False))


def _whole(c: Column) -> Column:
    return F.least(F.greatest(F.floor(c * STEPS), F.lit(-LARGEST)), F.lit(LARGEST)).cast("long") + F.lit(SHIFT)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            part = batch.slice(k, BLOCK)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        release()


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as 64-bit integers where they hold it, else as Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums)))
    if most < 1 << 61:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _squares(m: np.ndarray) -> list[int | None]:
    """Exact sums of squares of the rows; null beyond 64 bits."""
    if m.dtype == object or m.shape[1] * int(np.abs(m).max(initial=0)) ** 2 >= 1 << 63:
        own = [sum(v * v for v in row) for row in m.tolist()]
        return [v if v < 1 << 63 else None for v in own]
    return (m * m).sum(1).tolist()


def _merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes], scratch: Scratch) -> bytes | None:
    """The one value that (node, data) rows merge to, FAN at a time by neighbouring nodes; none for no rows."""
    parts = scratch.settled(parts)
    top = parts.agg(F.max("node")).first()[0]
    if top is None:
        return None

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        return pa.table({"node": table.column("up").slice(0, 1), "data": pa.array([merge(table.column("data").to_pylist())], pa.binary())})

    nodes = top + 1
    while nodes > 1:
        parts = parts.withColumn("up", F.floor(F.col("node") / FAN)).groupBy("up").applyInArrow(run, "node long, data binary")
        nodes = -(-nodes // FAN)
    return bytes(parts.first()["data"])


def _one_row(data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([data], pa.binary())], ["node", "data"])


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sum of each dimension; d rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for _, x in _blocks(batches, d):
            own = x if int(np.abs(x).max(initial=0)) < 1 << 50 else x.astype(object)
            n, total = n + len(x), [a + b for a, b in zip(total, own.sum(0).tolist())]
        if n:
            yield pa.RecordBatch.from_pydict({"at": pa.array(range(d), pa.int32()), "total": pa.array([str(v) for v in total]), "n": pa.array([n] * d, pa.int64())})

    found = fit.mapInArrow(run, "at int, total string, n long").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    own = {r["at"]: r for r in found}
    return (own[0]["n"], [int(own[k]["total"]) for k in range(d)]) if own else (0, [])


def _last_r(fit: DataFrame, d: int, n: int, sums: list[int], scratch: Scratch) -> np.ndarray:
    """R of the centred different vectors."""

    def stacked(parts: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.vstack(parts), mode="r")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for _, x in _blocks(batches, d):
            r = stacked([r, (_deviations(x, n, sums) / n).astype(np.float64)])
        if len(r):
            yield _one_row(r.tobytes())

    read = lambda data: np.frombuffer(data).reshape(-1, d)
    return read(_merged(fit.mapInArrow(run, "node long, data binary"), lambda parts: stacked([read(x) for x in parts]).tobytes(), scratch))


class Spread:
    """Number, mean and centred products of rows; sums of two are exact identities, so nothing large cancels."""

    def __init__(self, n: float, mean: np.ndarray, products: np.ndarray):
        self.n, self.mean, self.products = n, mean, products

    @classmethod
    def of(cls, z: np.ndarray) -> Spread:
        mean = z.mean(0)
        return cls(len(z), mean, (z - mean).T @ (z - mean))

    def __add__(self, other: Spread) -> Spread:
        n, apart = self.n + other.n, other.mean - self.mean
        return Spread(n, self.mean + apart * (other.n / n), self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n))

    def data(self) -> bytes:
        return np.concatenate([[self.n], self.mean, self.products.ravel()]).tobytes()

    @classmethod
    def read(cls, data: bytes, k: int) -> Spread:
        x = np.frombuffer(data)
        return cls(x[0], x[1 : k + 1], x[k + 1 :].reshape(k, k))


def _identity_error(fit: DataFrame, d: int, n: int, sums: list[int], basis: np.ndarray, scratch: Scratch) -> float:
    """The largest entry of the whitened vectors' covariance minus the identity."""
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, d):
            own = Spread.of((_deviations(x, n, sums) / n).astype(np.float64) @ basis)
            total = total + own if total else own
        if total:
            yield _one_row(total.data())

    def merge(parts: list[bytes]) -> bytes:
        total = Spread.read(parts[0], k)
        for x in parts[1:]:
            total = total + Spread.read(x, k)
        return total.data()

    last = Spread.read(_merged(fit.mapInArrow(run, "node long, data binary"), merge, scratch), k)
    return float(np.abs(last.products / n - np.eye(k)).max())


def whitened(rows: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row with a finite vector.

    Left out are rows whose vector is null, empty, or holds null, NaN or
    infinite entries, and rows of another length than most rows have (of two
    lengths as frequent, the longer counts). Each different vector counts once
    in the fit, however many rows repeat it; each row has its own results, a
    null id too. Directions in which the vectors don't differ have no
    component, so a table of one vector, or an empty one, gives no rows.
    deviation is null where it's beyond 64 bits. A component's largest entry is
    positive. Other columns aren't read.
    """
    spark, kind = rows.sparkSession, rows.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    scratch = Scratch(spark)
    fine = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(_finite(F.col("v")))
    length = fine.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], schema)
    d = length["d"]
    exact = fine.where(F.size("v") == d).select("vec_id", F.transform("v", _whole).alias("x"))
    fit = scratch.settled(exact.select("x").distinct())
    n, sums = _sums(fit, d)
    _, s, right = np.linalg.svd(_last_r(fit, d, n, sums, scratch), full_matrices=False)
    k = min(components, int((s > s[0] * d * 2.0**-50).sum()))
    if not k:
        return spark.createDataFrame([], schema)
    signs = np.sign(right[np.arange(k), np.abs(right[:k]).argmax(1)])
    basis = (right[:k] * signs[:, None] * (n**0.5 / s[:k])[:, None]).T.copy()
    explained = s[:k] ** 2 / (s**2).sum()
    error = _identity_error(fit, d, n, sums, basis, scratch)
    scratch.keep()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _blocks(batches, d):
            m, rows_in = _deviations(x, n, sums), len(x)
            z = (m / n).astype(np.float64) @ basis
            each = np.repeat(np.arange(rows_in), k)
            deviation = pa.array(_squares(m), pa.int64()).take(pa.array(each))
            many = lambda v: pa.array(np.tile(v, rows_in))
            columns = [batch.column("vec_id").take(pa.array(each)), many(np.arange(1, k + 1, dtype=np.int32)), pa.array(np.full(len(each), n)), deviation, pa.array(z.ravel()), many(explained), pa.array(np.full(len(each), error))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return exact.mapInArrow(run, schema)
