"""Embedding whitening by a blockwise QR and a bidiagonal qd solver.

The exact sums of the dimensions come first, so every entry is centred before anything is multiplied.
Each task then keeps one triangular factor R of the centred rows it has seen, as large as a vector is
long; the factors meet FAN at a time on a reduction tree. The last one holds all that is needed of any
number of rows: its squared singular values over n are the eigenvalues of the covariance, which is never
formed, so small ones keep their digits. `bidiagonal.py` finds values and vectors.

A row's whitened values are its projections on the leading components over the root of the eigenvalue.
On the driver are the sums of the dimensions and the components: as many numbers as COMPONENTS vectors.

Defined cases: vectors that are null, or hold null or non-finite entries, or an entry whose number is
no long, go. Vectors of another length than the most frequent one (the longer if there are two) go too,
as they have no covariance with the rest. Repeated rows count as often as they occur; null ids stay. A
table without variance, or without rows, has no components and gives no rows. There are fewer than
COMPONENTS components if the vectors are shorter, or the covariance has a lower rank. `deviation` is
null where it is no long. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.bidiagonal import singular
from ledgerline.llm.frames import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
# Rows factored at once, and factors that meet in a task.
BLOCK_ROWS = 4096
FAN = 16

_LONG = 1 << 63
_LARGEST = float(1 << 56)
_FACTOR = "no long, factor binary"


@dataclass(frozen=True)
class Whitening:
    """What the rows are projected with: sums by dimension, unit components as columns, eigenvalues."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _centred(x, self.n, self.sums)


def _usable(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows with finite entries: their places, lengths, where their entries begin, and all entries."""
    lists = batch.column("embedding")
    bounds = lists.offsets.to_numpy()
    flat = lists.values
    entries = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        bad = np.concatenate([[0], np.cumsum(~(np.abs(entries) < _LARGEST))])
    fine = np.asarray(lists.is_valid()) & (bad[bounds[1:]] == bad[bounds[:-1]])
    rows = np.flatnonzero(fine)
    return rows, np.diff(bounds)[rows], bounds[:-1][rows], entries


def _numbers(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and long entries of the usable rows of one length, some rows at a time."""
    rows, sizes, begins, entries = _usable(batch)
    mine = np.flatnonzero(sizes == size)
    for k in range(0, len(mine), BLOCK_ROWS):
        some = mine[k : k + BLOCK_ROWS]
        c = entries[begins[some][:, None] + np.arange(size)]
        yield rows[some], np.floor(SCALE * c).astype(np.int64) + SHIFT


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact n * x - S, and the centred entries. Python's integers where 64 bits might not do."""
    bound = n * float(np.abs(x).max(initial=0)) + float(max(map(abs, sums.tolist()), default=0))
    if bound * bound * max(x.shape[1], 1) >= _LONG / 2:
        x, sums = x.astype(object), sums.astype(object)
    exact = n * x - sums
    # A quotient of integers is rounded once.
    return exact, (exact / n).astype(float)


def _vectors(table: DataFrame) -> DataFrame:
    return table.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def totals(table: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums by dimension, of the vectors of the most frequent length."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            _, sizes, _, _ = _usable(batch)
            for size in np.unique(sizes).tolist():
                if not size:
                    continue
                for _, x in _numbers(batch, size):
                    # Below 2**63 / BLOCK_ROWS a block's sum fits a long.
                    wide = np.abs(x).max(initial=0) >= _LONG // (2 * BLOCK_ROWS)
                    own = seen.setdefault(size, [0, np.zeros(size, dtype=object)])
                    own[0] += len(x)
                    own[1] += (x.astype(object) if wide else x).sum(axis=0)
        for size, (n, sums) in seen.items():
            values = pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))
            columns = [pa.array([v] * size, pa.int64()) for v in (size, n)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(range(size), pa.int32()), values], ["size", "n", "pos", "total"]
            )

    sums = stored(
        _vectors(table).mapInArrow(partial, "size long, n long, pos int, total decimal(38,0)"), "sums"
    )
    sums = sums.groupBy("size", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    most = sums.where("pos = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").first()
    if most is None:
        return 0, np.empty(0, dtype=np.int64)
    # One row per dimension.
    rows = sums.where(F.col("size") == F.lit(most["size"])).orderBy("pos").collect()
    exact = [int(r["total"]) for r in rows]
    small = max(map(abs, exact)) < _LONG
    return most["n"], np.array(exact, dtype=np.int64 if small else object)


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def factor(table: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of a QR factorisation of all centred rows."""
    size = len(sums)

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.empty((0, size))
        for batch in batches:
            for _, x in _numbers(batch, size):
                r = _triangle(np.vstack([r, _centred(x, n, sums)[1]]))
        if len(r):
            yield row(TaskContext.get().partitionId(), r)

    def row(no: int, r: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([no], pa.int64()), pa.array([r.astype("<f8").tobytes()])]
        return pa.RecordBatch.from_arrays(columns, ["no", "factor"])

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        blocks = [np.frombuffer(b.as_buffer(), "<f8").reshape(-1, size) for b in table.column("factor")]
        return pa.Table.from_batches([row(table.column("no")[0].as_py() // FAN, _triangle(np.vstack(blocks)))])

    factors = stored(_vectors(table).mapInArrow(of_task, _FACTOR), "factors")
    last = factors.agg(F.max("no")).first()[0]
    while last:
        met = factors.groupBy(F.expr(f"no div {FAN}").alias("run")).applyInArrow(meet, _FACTOR)
        factors, last = stored(met, "factors"), last // FAN
    r = np.frombuffer(factors.first()["factor"], "<f8").reshape(-1, size)
    return np.vstack([r, np.zeros((size - len(r), size))])


def fit(table: DataFrame, count: int = COMPONENTS) -> Whitening:
    """Components of the covariance of a table of vectors, at most `count`."""
    n, sums = totals(table)
    if not n:
        return Whitening(0, sums, np.empty((0, 0)), np.empty(0), 0.0)
    squares, vectors = singular(factor(table, n, sums), count)
    # Either sign is right; the largest entry is made positive.
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    return Whitening(n, sums, vectors, squares[: vectors.shape[1]] / n, float(squares.sum() / n))


def identity_error(table: DataFrame, model: Whitening) -> float:
    """Largest entry by which the covariance of the whitened rows differs from the identity."""
    k, size = len(model.values), len(model.sums)
    project = model.vectors / np.sqrt(model.values)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whitened rows are centred, so sums of products and of values lose nothing.
        total = np.zeros((k + 1, k))
        for batch in batches:
            for _, x in _numbers(batch, size):
                z = model.centred(x)[1] @ project
                total += np.vstack([z.T @ z, z.sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size)), pa.array(total.ravel())], ["pos", "total"]
        )

    sums = stored(_vectors(table).mapInArrow(products, "pos long, total double"), "products")
    rows = sums.groupBy("pos").agg(F.sum("total").alias("total")).orderBy("pos").collect()
    total = np.array([r["total"] for r in rows]).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def report(table: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """Whitened values of every usable vector, a row per component, with what they were made from."""
    model = fit(table, count)
    k, size = len(model.values), len(model.sums)
    schema = (
        "vec_id long, component int, n long, deviation long,"
        " whitened double, explained double, identity_error double"
    )
    if not k:
        return table.sparkSession.createDataFrame([], schema)
    project = model.vectors / np.sqrt(model.values)
    explained, error = model.values / model.trace, identity_error(table, model)
    names = [c.split()[0] for c in schema.split(", ")]

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _numbers(batch, size):
                exact, centred = model.centred(x)
                squares = (exact * exact).sum(axis=1).tolist()
                deviation = pa.array([s if s < _LONG else None for s in squares], pa.int64())
                each, m = np.repeat(np.arange(len(rows)), k), len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(rows[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n)),
                        deviation.take(pa.array(each)),
                        pa.array((centred @ project).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names,
                )

    return _vectors(table).mapInArrow(whiten, schema)
