"""Deleting rows of a table in place: only files that hold a row to delete are rewritten.

The first pass reads key columns only, between the least and the greatest key to delete, a
condition by which Parquet skips row groups; it yields the names of the files that hold a
row to delete.  Only these are then read in full and written again.  With stored statistics
per file (``sketches.refresh_statistics``) files without a key in that range are not even
opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coldshelf.operators.merge import delete_rows, delete_rows_exact
from coldshelf.operators.sketches import refresh_statistics
from coldshelf.operators.swap import Swap, finish_swap, flat_files, swap_files
from coldshelf.plans.staging import stage

# types whose least and greatest value mean something to a scan
_ORDERED = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "string")


def delete_rows_in_files(
    spark: SparkSession, path: str, locators: DataFrame, keys: Sequence[str] | None = None, store: str | None = None
) -> Swap:
    """Remove the rows named by key tuples from the table at ``path``; NULL matches NULL.

    Without a unique key the match is on all columns.  ``store`` is where statistics per file
    are kept; they are brought up to date first.  The result says which files were
    rewritten; deleted rows are the difference of its counts.
    """
    finish_swap(spark, path)
    columns = list(keys or locators.columns)
    named = stage(locators.select(*columns).distinct(), "named")
    table = _searched(spark, path, named, columns, store)
    if table is None:
        return Swap((), 0, 0)
    hits = within(table, named, columns).select(*columns, F.col("_metadata.file_name").alias("_file"))
    touched = _matching(hits, named, columns).select("_file").distinct()
    return swap_files(spark, path, _names(touched), lambda rows: delete_rows(rows, named, columns))


def delete_copies_in_files(spark: SparkSession, path: str, archived: DataFrame, store: str | None = None) -> Swap:
    """Remove exactly as many copies of each row from the table at ``path`` as were archived.

    Of files that hold copies of one row, those with most of them are rewritten first, and
    no more than are needed.  ``archived`` has the table's columns.
    """
    finish_swap(spark, path)
    columns = archived.columns
    gone = stage(archived.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("_gone")), "gone")
    table = _searched(spark, path, gone, columns, store)
    if table is None:
        return Swap((), 0, 0)
    hits = within(table, gone, columns).select(*columns, F.col("_metadata.file_name").alias("_file"))
    # one row per distinct row and file, however many copies the file holds
    held = hits.groupBy(*columns, "_file").agg(F.count(F.lit(1)).alias("_held"))
    held = _matching(held, gone, columns, "_gone")
    others = W.partitionBy(*columns).orderBy(F.desc("_held"), "_file").rowsBetween(W.unboundedPreceding, -1)
    needed = held.withColumn("_before", F.coalesce(F.sum("_held").over(others), F.lit(0))).where("_before < _gone")
    return swap_files(
        spark, path, _names(needed.select("_file").distinct()), lambda rows: delete_rows_exact(rows, archived.select(*columns))
    )


def _names(touched: DataFrame) -> list[str]:
    """Names of files: no more than the table has, which the driver lists anyhow."""
    return sorted(r["_file"] for r in touched.collect())


def _searched(
    spark: SparkSession, path: str, named: DataFrame, columns: Sequence[str], store: str | None
) -> DataFrame | None:
    """The part of a table in which to search: all of it, or the files whose stored statistics
    allow for a named key; None if there is none."""
    if store is None:
        return spark.read.parquet(path)
    refresh_statistics(spark, path, store)
    stats = spark.read.option("mergeSchema", "true").parquet(store)

    def may_hold(b: Bounds) -> Column:
        figures = F.col(f"`c_{b.column}`")
        inside = F.lit(False) if b.low is None else (figures["hi"] >= b.low) & ((figures["lo"] <= b.high) | b.open_above)
        return inside | (figures["filled"] < F.col("n_rows")) if b.nulls else inside

    found = _bounds(named, columns)
    wanted = stats.where(reduce(Column.__and__, [F.coalesce(may_hold(b), F.lit(False)) for b in found], F.col("n_rows") > 0))
    names = {r["file"] for r in wanted.select("file").collect()} & flat_files(spark, path).keys()
    if not names:
        return None
    return spark.read.parquet(*[f"{path.rstrip('/')}/{n}" for n in sorted(names)])


class Bounds(NamedTuple):
    """What the named keys span in one column; a NaN is beyond any bound that a scan knows."""

    column: str
    low: Any
    high: Any
    open_above: bool
    nulls: bool


def _bounds(named: DataFrame, columns: Sequence[str]) -> list[Bounds]:
    kinds = dict(named.dtypes)
    ordered = [c for c in columns if kinds[c] in _ORDERED or kinds[c].startswith("decimal")]
    if not ordered:
        return []
    figures = [f(c).alias(f"{name}{i}") for i, c in enumerate(ordered) for name, f in (("lo", F.min), ("hi", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls{i}") for i, c in enumerate(ordered)]
    found = named.agg(*figures, *nulls).first()
    return [
        Bounds(c, found[f"lo{i}"], found[f"hi{i}"], found[f"hi{i}"] != found[f"hi{i}"], found[f"nulls{i}"] > 0)
        for i, c in enumerate(ordered)
    ]


def within(table: DataFrame, named: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose keys lie between the least and the greatest one named, column by column."""

    def between(b: Bounds) -> Column:
        column = F.col(b.column)
        if b.low is None:
            return column.isNull()
        inside = column >= b.low if b.open_above else (column >= b.low) & (column <= b.high)
        return inside | column.isNull() if b.nulls else inside

    found = _bounds(named, columns)
    return table.where(reduce(Column.__and__, [between(b) for b in found])) if found else table


def _matching(rows: DataFrame, named: DataFrame, columns: Sequence[str], *more: str) -> DataFrame:
    """Rows whose key is named; NULL matches NULL."""
    names = [f"_k{i}" for i in range(len(columns))]
    there = named.select(*[F.col(c).alias(n) for c, n in zip(columns, names)], *more)
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(columns, names)])
    return rows.join(there, match, "inner" if more else "left_semi").drop(*names)
