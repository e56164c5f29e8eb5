"""Embedding whitening by distributed block matrices.

Entries become integers x = floor(scale * c) + offset.  Tasks fill blocks of centred rows, which are indexed
and make a ``BlockMatrix``; its transpose times itself is the scatter, the driver takes the eigenvectors of the
(dimension x dimension) covariance, and a second multiplication by the whitening matrix projects every row.
Sums and deviations are exact integers; a centred entry is (n * x - S) / n, rounded once.

The blocks lie in one block column per group of ``group`` row blocks, and the middle dimension of the product is
split, so a task multiplies a few blocks and adds up a bounded number of products; a tree adds the groups.
On the driver are the sums (a number per dimension), the covariance and the indexes of the blocks, one for each 2 MB.

Rows are dropped whose vector is null, holds null or non-finite entries, or has another length than most vectors
(ties: the longer).  Entries beyond 64 bits are clipped to them; a deviation of over 38 digits is null.  A
component without variance has null ``whitened`` values, and no share of a variance of zero.  Repeated rows and
null ids are kept each.  Other columns are not read.  Where no row remains, the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from serieslake.session import materialize

SCALE, OFFSET = 1024, 100_000
BLOCK_VALUES = 1 << 18  # of a block of rows: 2 MB
SPLIT = 16  # row blocks that a task multiplies
_CLIP = float(1 << 62)
_WHOLE = pa.decimal128(38, 0)


class Fit(NamedTuple):
    n: int
    sums: np.ndarray  # of x for each dimension, as Python integers


def _exact(values: np.ndarray, bound: int) -> np.ndarray:
    """The integers themselves where ``bound`` fits 62 bits, else as Python integers."""
    return values if bound < 1 << 62 else values.astype(object)


def _largest(values: np.ndarray) -> int:
    return int(np.abs(values).max(initial=0))


def _wide(values) -> pa.Array:
    """Whole numbers of any size as decimals; null beyond 38 digits."""
    return pa.array([v if -(10**38) < v < 10**38 else None for v in map(int, values)], _WHOLE)


def _lists(values: pa.Array, width: int) -> pa.ListArray:
    """Lists of ``width`` values each, one row."""
    return pa.ListArray.from_arrays(pa.array([0, width], pa.int32()), values)


def integers(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors: rows of usable ones and their matrix of x."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(vectors).cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls read as NaN
    begins = np.cumsum(lengths) - lengths
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = (lengths > 0) & (bad[begins + lengths] == bad[begins])
    for length in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == length))
        c = flat[begins[rows][:, None] + np.arange(length)]
        with np.errstate(over="ignore"):
            x = np.clip(np.floor(c * SCALE), -_CLIP, _CLIP).astype(np.int64) + OFFSET
        yield rows, x


def _integer_rows(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """length, n, ids, x, sums: usable vectors in runs of rows, with their sums per dimension."""
    kind = vectors.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch.column(1)):
                length = x.shape[1]
                size = max(1, BLOCK_VALUES // length)
                for start in range(0, len(rows), size):
                    part = x[start : start + size]
                    ids = batch.column(0).take(pa.array(rows[start : start + size]))
                    sums = _wide(_exact(part, _largest(part) * len(part)).sum(0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([length]), pa.array([len(part)]), _lists(ids, len(part)), _lists(pa.array(part.ravel()), part.size), _lists(sums, length)],
                        names=["length", "n", "ids", "x", "sums"],
                    )

    schema = f"length long, n long, ids array<{kind}>, x array<long>, sums array<decimal(38,0)>"
    return materialize(vectors.select(key, column).mapInArrow(run, schema), "vectors")


def _fit(rows: DataFrame) -> Fit | None:
    """n and S of the vectors of the most frequent length; None without any."""
    most = rows.groupBy("length").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return None
    sums = rows.filter(F.col("length") == most.length).select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    return Fit(most.n, np.array([int(row.s) for row in sorted(sums.collect(), key=lambda row: row["at"])], object))


def _blocks(rows: DataFrame, fit: Fit, group: int) -> DataFrame:
    """at (block row, block column), subMatrix of centred rows, their ids and exact deviations."""
    d, kind = len(fit.sums), rows.schema["ids"].dataType.elementType.simpleString()
    size = max(1, BLOCK_VALUES // d)
    widest = _largest(fit.sums)

    def block(ids: pa.Array, x: np.ndarray, seq: int) -> pa.RecordBatch:
        bound = fit.n * _largest(x) + widest
        x, sums = _exact(x, bound), fit.sums if bound >= 1 << 62 else fit.sums.astype(np.int64)
        apart = fit.n * x - sums
        squares = _exact(apart, _largest(apart) ** 2 * d)
        deviation = _wide((squares * squares).sum(1))
        centred = (apart / fit.n).astype(np.float64)
        matrix = [pa.array([1], pa.int8()), pa.array([len(x)], pa.int32()), pa.array([d], pa.int32())]
        matrix += [pa.array([None], pa.list_(pa.int32()))] * 2 + [_lists(pa.array(centred.ravel(order="F")), centred.size), pa.array([False])]
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([seq], pa.int64()), _lists(ids, len(x)), _lists(deviation, len(x)),
             pa.StructArray.from_arrays(matrix, names=MatrixUDT.sqlType().names)],
            names=["part", "seq", "ids", "deviation", "subMatrix"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, seq = [], [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                ids.append(batch.column(0)[k].values)
                held.append(np.asarray(batch.column(1)[k].values).reshape(-1, d))
                while sum(map(len, held)) >= size:
                    x, all_ids = np.concatenate(held), pa.concat_arrays(ids)
                    yield block(all_ids[:size], x[:size], seq)
                    held, ids, seq = [x[size:]], [all_ids[size:]], seq + 1
        if sum(map(len, held)):
            yield block(pa.concat_arrays(ids), np.concatenate(held), seq)

    schema = StructType.fromDDL(f"part long, seq long, ids array<{kind}>, deviation array<decimal(38,0)>").add(StructField("subMatrix", MatrixUDT()))
    made = materialize(rows.filter(F.col("length") == d).select("ids", "x").mapInArrow(run, schema), "blocks")
    counts = made.groupBy("part").agg(F.count("*").alias("n"))  # a row per task that made blocks
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    row = F.col("before") + F.col("seq")
    at = F.struct(row.alias("_1"), F.floor(row / group).cast(LongType()).alias("_2"))
    return made.join(F.broadcast(before), "part").select(at.alias("at"), "subMatrix", "ids", "deviation")


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a times b; the middle dimension goes to ``splits`` tasks for each part of the result."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, a.rowsPerBlock, b.colsPerBlock)


def _eigen(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues, falling, and their unit vectors (the largest entry is positive); 0 for what is rounding."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    values = np.where(values > values.max(initial=0) * len(covariance) * 8 * np.finfo(float).eps, values, 0)
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])


def _totals(rows: DataFrame, make, width: int) -> np.ndarray:
    """The sum of ``make(matrix)`` over all blocks of whitened rows; one row per task is gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for values in batch.column(0):
                total = total + make(np.asarray(values.values).reshape(-1, width))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([_lists(pa.array(total.ravel()), total.size)], names=["sums"])

    sums = rows.select("whitened").mapInArrow(run, "sums array<double>")
    parts = sums.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s")).collect()
    return np.array([row.s for row in sorted(parts, key=lambda row: row["at"])])


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", column: str = "embedding", group: int = 4096) -> DataFrame:
    """``key``, component, n, deviation (decimal(38,0)), whitened, explained, identity_error of each usable row and component."""
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = _integer_rows(vectors, key, column)
    fit = _fit(rows)
    if fit is None:
        return spark.createDataFrame([], schema)
    d = len(fit.sums)
    blocks = _blocks(rows, fit, group)
    count = blocks.count()
    groups, size = -(-count // group), max(1, BLOCK_VALUES // d)
    centred = BlockMatrix(callMLlibFunc("createBlockMatrix", blocks.select("at", "subMatrix"), size, d, count * size, groups * d), size, d)
    scatter = _times(centred.transpose(), centred, -(-count // SPLIT)).blocks.map(lambda block: block[1].toArray()).treeReduce(np.add)
    covariance = scatter / fit.n
    values, directions = _eigen(covariance, components)
    width, varied = len(values), values > 0
    project = np.where(varied, directions / np.sqrt(np.where(varied, values, 1)), 0)
    whitening = DenseMatrix(d, width, project.ravel(order="F"))
    stacked = BlockMatrix(spark.sparkContext.parallelize([((g, 0), whitening) for g in range(groups)], 1), d, width)
    projected = centred.multiply(stacked).blocks.map(lambda block: (block[0][0], block[1].toArray().ravel().tolist()))
    found = spark.createDataFrame(projected, "row long, whitened array<double>")
    whitened = materialize(blocks.select(F.col("at._1").alias("row"), "ids", "deviation").join(found, "row").drop("row"), "whitened")

    mean = _totals(whitened, lambda w: w.sum(0), width) / fit.n
    covered = _totals(whitened, lambda w: (w - mean).T @ (w - mean), width).reshape(width, width) / fit.n
    apart = np.abs(covered - np.eye(width))[np.ix_(varied, varied)]
    error, trace = float(apart.max()) if apart.size else None, float(np.trace(covariance))
    explained = [float(value) / trace if trace > 0 else None for value in values]

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, deviation, values in zip(*batch.columns, strict=True):
                m = len(ids)
                each = pa.array(np.repeat(np.arange(m), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(each), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), m)), pa.array(np.full(m * width, fit.n)),
                        deviation.values.take(each), pa.array(np.asarray(values.values), mask=np.tile(~varied, m)),
                        pa.array(explained * m, pa.float64()), pa.array([error] * (m * width), pa.float64()),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whitened.select("ids", "deviation", "whitened").mapInArrow(flat, schema)
