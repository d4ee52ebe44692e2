"""Whitening vectors by their leading principal components.

Entries become whole numbers of 1/256, so sums over any partitioning are exact.  Spark
makes the list of distinct vectors, its sums and its centred products; the products of
all tasks add up to one matrix of the vectors' dimension, whose leading eigenpairs the
driver finds by spectrum slicing.  Each vector is then projected where it lies.

Defined results: vectors that are null, empty, or hold a null or an entry that is not
finite are dropped, and so are vectors of another length than most have (the longer of
equally frequent ones).  Repeated vectors count once for the components and each get their
rows; ties between eigenvalues give any orthogonal components.  Components without
variance are left out, so fewer distinct vectors than components give fewer rows, and a
single one or an empty table none.  A deviation beyond 64 bits is null.  Entries beyond 64
bits after scaling count as the largest number that fits.  Null ids stay null, and other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.spectrum import leading_eigenpairs
from coldshelf.plans.staging import stage

_ROWS = 4096  # vectors that are multiplied at a time


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256
) -> DataFrame:
    """One row per vector and component: ``vec_id``, ``component`` from 1, ``n`` distinct vectors,
    ``deviation`` (sum of squares of n·x − S), ``whitened``, ``explained``, ``identity_error``."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    result = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    # one length per vector length that occurs; the most frequent one is kept
    usable = vectors.select(F.col(id_col).alias("vec_id"), _scaled(F.col(vector_col), scale).alias("x")).where(
        "x IS NOT NULL"
    )
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], result)
    d = lengths["d"]
    usable = usable.where(F.size("x") == d)
    fit = stage(usable.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    n, sums = fit.count(), _sums(fit, d)
    mean = np.array([s / n for s in sums])  # whole numbers divide without a first rounding
    covariance = _products(fit, mean, np.eye(d)) / n
    values, directions = leading_eigenpairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], result)
    projection = directions.T / np.sqrt(values)
    spread = _products(fit, mean, projection, centre=_means(fit, mean, projection, n)) / n
    error = float(np.abs(spread - np.eye(len(values))).max())
    explained = values / np.trace(covariance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for ids, x in _blocks(batches, d):
            whitened = (x - mean) @ projection
            m = len(x)
            columns = [
                ids.take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)),
                _deviations(x, n, sums).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(whitened.ravel()),
                pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in result.split(", ")])

    return usable.mapInArrow(run, result)


def _scaled(vector: Column, scale: int) -> Column:
    """The vector in whole numbers, or null if it can't be used."""
    def entry(c: Column) -> Column:
        return c.cast("double")

    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) != F.lit(float("inf"))))
    whole = F.transform(vector, lambda c: F.floor(entry(c) * scale).cast("bigint"))
    return F.when(finite & (F.size(vector) > 0), whole)


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors, some thousand at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield part.column(0), part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> list[int]:
    """The exact sum of each dimension over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, dtype=object)
        for _, x in _blocks(batches, d):
            small = max(int(x.max()), -int(x.min())) < 2**62 // _ROWS
            total = total + (x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array([str(s) for s in total])], ["i", "s"])

    partial = fit.mapInArrow(run, "i bigint, s string")
    rows = partial.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r["s"]) for r in sorted(rows, key=lambda r: r["i"])]


def _products(fit: DataFrame, mean: np.ndarray, projection: np.ndarray, centre: np.ndarray | None = None) -> np.ndarray:
    """The sum over all vectors of y yᵀ, where y is the centred vector's projection, less ``centre``."""
    d, k = projection.shape
    plain = k == d and bool((projection == np.eye(d)).all())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for _, x in _blocks(batches, d):
            y = x - mean if plain else (x - mean) @ projection
            if centre is not None:
                y = y - centre
            total += y.T @ y
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "s"])

    rows = fit.mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    i, j, s = (rows.column(c).to_numpy() for c in ("i", "j", "s"))
    whole = np.zeros((k, k))
    whole[i, j] = whole[j, i] = s
    return whole


def _means(fit: DataFrame, mean: np.ndarray, projection: np.ndarray, n: int) -> np.ndarray:
    """The mean projection of the centred vectors, zero but for rounding."""
    d, k = projection.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k)
        for _, x in _blocks(batches, d):
            total += ((x - mean) @ projection).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(total)], ["i", "s"])

    rows = fit.mapInArrow(run, "i bigint, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    return np.array([r["s"] for r in sorted(rows, key=lambda r: r["i"])]) / n


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Per vector the exact sum of squares of n·x − S; null beyond 64 bits."""
    bound = n * int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) + max(map(abs, sums))
    if bound * bound * x.shape[1] < 2**63:
        apart = n * x - np.array(sums, dtype=np.int64)
        return pa.array((apart * apart).sum(axis=1))
    apart = n * x.astype(object) - np.array(sums, dtype=object)
    return pa.array([v if v < 2**63 else None for v in (apart * apart).sum(axis=1).tolist()], pa.int64())
