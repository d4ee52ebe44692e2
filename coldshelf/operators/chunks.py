"""Cutting a table into chunks of a fixed number of rows in key order.

Numbering rows globally needs one range shuffle and no un-partitioned window: rows are
range partitioned and sorted, the sorted partitions are staged with the row's place in
its partition, and a prefix sum over the partition sizes (one number per partition)
turns that place into a global one.

Rows that tie on the keys are ordered by their remaining columns.  Rows equal in every
column would all fall in one range, so they travel as one row with a count and are
multiplied again afterwards, in blocks spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coldshelf.operators.predicates import keyset_predicate
from coldshelf.plans.staging import stage

# monotonically_increasing_id: partition number in the upper bits, row in the lower 33
_ROW_BITS = 33
# neighbouring rows whose weights are summed together
_RUN_BITS = 16
_BLOCK = 1 << 16


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Ordered(NamedTuple):
    """``rows`` with ``_start``, the weight before each row; the whole weight; and whether
    every row weighs one."""

    rows: DataFrame
    total: int
    single: bool


def stage_in_order(
    df: DataFrame, order: Sequence[str], weight: str | None = None, partitions: int | None = None
) -> Ordered:
    """Number rows, or sum up their weights, in a global order.

    ``order`` must tell all rows apart.  Unless ``partitions`` is given, adaptive
    execution joins neighbouring small ranges.
    """
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    staged = stage(
        ranged.sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id()),
        "ordered",
    )
    _check_places(staged)
    # other weights than one show in the files' statistics, mostly without reading rows
    if weight is not None and not staged.where(F.col(weight) != 1).isEmpty():
        return _weighted(staged, weight)
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    part = F.shiftright("_slot", _ROW_BITS).cast("int")
    starts = _starts(staged.groupBy(part.alias("part")).agg((F.max(row) + 1).alias("size")))
    return Ordered(staged.withColumn("_start", row + F.get(F.lit(starts), part)).drop("_slot"), starts[-1], True)


def _check_places(staged: DataFrame) -> None:
    """A range with more rows than the lower bits can count would run into the next one."""
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = staged.groupBy(part.alias("part")).agg((F.max(row) + 1).alias("size"))
    if (sizes.agg(F.sum("size").alias("n")).first()["n"] or 0) != staged.count():
        raise ValueError(f"a range holds more than 2^{_ROW_BITS} rows: ask for more partitions")


def _starts(sizes: DataFrame) -> list[int]:
    """What precedes each range partition, and the total, from one number per partition."""
    found = {row["part"]: row["size"] for row in sizes.collect()}
    return [0, *accumulate(found.get(p, 0) for p in range(max(found, default=-1) + 1))]


def _weighted(staged: DataFrame, weight: str) -> Ordered:
    """Running sums of weights over the staged order.

    Rows are summed in runs of neighbours, so no task holds more than some runs however
    large a range is; the sums of whole runs are a small table of their own.
    """
    runs = staged.withColumn("_run", F.shiftright("_slot", _RUN_BITS))
    part = F.shiftright("_run", _ROW_BITS - _RUN_BITS).cast("int")
    sums = stage(runs.groupBy("_run").agg(F.sum(weight).alias("_sum")), "runs")
    starts = _starts(sums.groupBy(part.alias("part")).agg(F.sum("_sum").alias("size")))

    in_part = W.partitionBy(part).orderBy("_run")
    before_run = F.sum("_sum").over(in_part) - F.col("_sum") + F.get(F.lit(starts), part)
    in_run = W.partitionBy("_run").orderBy("_slot")
    rows = (
        runs.withColumn("_within", F.sum(weight).over(in_run) - F.col(weight))
        .join(sums.select("_run", before_run.alias("_before")), "_run")
        .withColumn("_start", F.col("_before") + F.col("_within"))
        .drop("_run", "_slot", "_within", "_before")
    )
    return Ordered(rows, starts[-1], False)


def multiply(df: DataFrame, first: Column, last: Column, out: str, block: int = _BLOCK) -> DataFrame:
    """One row per whole number from ``first`` to ``last``.

    Rows standing for more than ``block`` numbers are first cut into blocks and spread
    over all partitions, so that no task has to emit a hot row's copies alone.
    """
    spans = df.withColumn("_first", first).withColumn("_span", last - first)
    light = spans.where(F.col("_span") < block).withColumn(
        out, F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_span")))
    )
    blocks = (
        spans.where(F.col("_span") >= block)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"_span DIV {block}"))))
        .repartition(shuffle_partitions(df))
    )
    low = F.col("_first") + F.col("_block") * block
    high = F.least(low + (block - 1), F.col("_first") + F.col("_span"))
    heavy = blocks.withColumn(out, F.explode(F.sequence(low, high))).drop("_block")
    return light.unionByName(heavy).drop("_first", "_span")


def assign_chunks(
    df: DataFrame,
    keys: Sequence[str],
    chunk_rows: int,
    unique: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Every row with its ``row_no`` (from 1) in key order and its ``chunk_id`` (from 0).

    With ``unique`` the keys are known to tell rows apart, which saves the shuffle that
    folds equal rows together.
    """
    _check_size(chunk_rows)
    if unique:
        ordered = stage_in_order(df, keys, partitions=partitions)
    else:
        folded = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        ordered = stage_in_order(folded, page_order(df, keys), "_copies", partitions)
    first = F.col("_start") + 1
    if ordered.single:
        numbered = ordered.rows.withColumn("row_no", first)
    else:
        numbered = multiply(ordered.rows, first, F.col("_start") + F.col("_copies"), "row_no")
    chunk = F.expr(f"(row_no - 1) DIV {int(chunk_rows)}")
    return numbered.select(*df.columns, "row_no", chunk.alias("chunk_id"))


def chunk_manifest(
    df: DataFrame,
    keys: Sequence[str],
    chunk_rows: int,
    unique: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """One row per chunk: ``chunk_id, n_rows, rows_done, lo, hi``.

    ``lo`` and ``hi`` are structs of the first and last key tuple.  Only key columns are
    read, and only the rows at chunk edges reach the final aggregation.
    """
    _check_size(chunk_rows)
    return manifest_of(key_order(df, keys, unique, partitions), keys, chunk_rows)


def key_order(
    df: DataFrame, keys: Sequence[str], unique: bool = False, partitions: int | None = None
) -> Ordered:
    """The keys of a table in order, each with its number of rows in ``_copies``.

    Several manifests can be cut from one such order.
    """
    if unique:
        keyed = df.select(*keys).withColumn("_copies", F.lit(1).cast("long"))
    else:
        keyed = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return stage_in_order(keyed, keys, None if unique else "_copies", partitions)


def manifest_of(ordered: Ordered, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    """The chunks of ``chunk_rows`` rows of an order of keys."""
    _check_size(chunk_rows)
    size = int(chunk_rows)
    total = ordered.total

    end = F.col("_start") + F.col("_copies")
    first_chunk = F.expr(f"_start DIV {size}")
    last_chunk = F.expr(f"(_start + _copies - 1) DIV {size}")
    at_edge = (
        (F.col("_start") % size == 0)
        | (end % size == 0)
        | (end == total)
        | (first_chunk != last_chunk)
    )
    edges = ordered.rows.where(at_edge)
    if ordered.single:
        edges = edges.withColumn("chunk_id", first_chunk)
    else:
        edges = multiply(stage(edges, "edges"), first_chunk, last_chunk, "chunk_id")
    begin_row = F.col("chunk_id") * size
    end_row = F.least(begin_row + size, F.lit(total))
    key = F.struct(*[F.col(k) for k in keys])
    return (
        edges.groupBy("chunk_id")
        .agg(
            F.max(F.when(F.col("_start") <= begin_row, key)).alias("lo"),
            F.max(F.when(end >= end_row, key)).alias("hi"),
        )
        .select(
            "chunk_id",
            (end_row - begin_row).alias("n_rows"),
            end_row.alias("rows_done"),
            "lo",
            "hi",
        )
    )


def next_page(
    df: DataFrame,
    keys: Sequence[str],
    after: Sequence[Any] | Mapping[str, Any] | None = None,
    n: int = 1,
    unique: bool = False,
    skip: int = 0,
) -> DataFrame:
    """The next ``n`` rows after a boundary in key order; ``after=None`` is the first page.

    Unless the keys are ``unique`` the order runs over the keys and then the remaining
    columns, and ``after`` holds the values of the last row seen in that order.  Where
    rows are equal in all columns, ``skip`` says how many copies of that last row were
    already seen, so that no copy is lost between two pages.
    """
    _check_size(n)
    order = list(keys) if unique else page_order(df, keys)
    if after is None:
        page = df
    elif skip:
        page = df.where(keyset_predicate(order, after, ">="))
    else:
        page = df.where(keyset_predicate(order, after, ">"))
    page = page.orderBy(*order)
    return (page.offset(skip) if skip else page).limit(n)


def page_order(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [*keys, *(c for c in df.columns if c not in keys)]


def _check_size(rows: int) -> None:
    if rows < 1:
        raise ValueError("a chunk needs at least one row")
