"""Finding unequal rows of two tables through a tree of range checksums.

Each side is reduced alone: its rows' hashes are summed per key range, in every task, so
what moves is one row per range and task.  Ranges whose sums agree are done with.  The
others are read again, by seeks that reach the scan, and cut into finer ranges, until they
are small; only keys of these last ranges are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldshelf.operators.compare import PIECES, compare_rows, row_pieces
from coldshelf.operators.ranges import Range, as_key, in_ranges, join_ranges, key_cuts, key_schema, range_of, ranges_between

_READ_RANGES = 32  # conditions in one scan


@dataclass(frozen=True)
class DrillDown:
    """``levels``: every range that was summed, (level, lo, hi, rows_a, rows_b, verdict), ``lo``
    included and ``hi`` not, NULL where open; ``rows``: the key tuples that differ, as
    ``compare_rows`` gives them."""

    levels: DataFrame
    rows: DataFrame


def drill_down(
    a: DataFrame, b: DataFrame, keys: Sequence[str], leaf_rows: int = 100_000, fanout: int = 256, max_levels: int = 12
) -> DrillDown:
    """Compare two tables of the same columns by key.

    Ranges of at most ``leaf_rows`` rows on either side are not cut further, nor are those
    that hold a single key.  Cuts come from samples of both sides, so a key with many rows
    gets a range of its own.
    """
    if set(a.columns) != set(b.columns):
        raise ValueError("both sides need the same columns")
    if fanout < 2 or leaf_rows < 1:
        raise ValueError("a range needs at least one row, a level two ranges")
    spark, b = a.sparkSession, b.select(*a.columns)
    reading: list[Range] = [(None, None)]
    log: list[tuple] = []
    for level in range(max_levels):
        here_a, here_b = in_ranges(a, keys, reading), in_ranges(b, keys, reading)
        chosen = {c for side in (here_a, here_b) for c in key_cuts(side, keys, fanout)}
        cuts = _in_order(a, keys, chosen | {edge for r in reading for edge in r if edge is not None})
        edges = ranges_between(cuts)
        sums_a, sums_b = _sums(here_a, keys, cuts), _sums(here_b, keys, cuts)
        bad, large = [], False
        for n in sorted(sums_a.keys() | sums_b.keys()):
            (rows_a, *rest_a), (rows_b, *rest_b) = sums_a.get(n, _NOTHING), sums_b.get(n, _NOTHING)
            same = (rows_a, *rest_a) == (rows_b, *rest_b)
            log.append((level, *edges[n], rows_a, rows_b, "same" if same else "different"))
            if not same:
                bad.append(n)
                large = large or max(rows_a, rows_b) > leaf_rows
        before, reading = reading, join_ranges(bad, edges, _READ_RANGES)
        if not bad or not large or reading == before:
            break
    rows = compare_rows(in_ranges(a, keys, reading), in_ranges(b, keys, reading), keys)
    key = key_schema(a, keys)
    schema = T.StructType(
        [
            T.StructField("level", T.IntegerType()), T.StructField("lo", key), T.StructField("hi", key),
            T.StructField("rows_a", T.LongType()), T.StructField("rows_b", T.LongType()), T.StructField("verdict", T.StringType()),
        ]
    )
    return DrillDown(spark.createDataFrame(log, schema), rows)


_NOTHING = (0, *[0 for _ in range(2 * len(PIECES))])


def _sums(df: DataFrame, keys: Sequence[str], cuts: Sequence[tuple]) -> dict[int, tuple]:
    """Per range the number of rows and the sums of two hashes: one row for each range."""
    pieces = [p for seed in (1, 2) for p in row_pieces(df.columns, seed)]
    figures = [F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(f"s{i}") for i, p in enumerate(pieces)]]
    found = df.groupBy(range_of(df, keys, cuts).alias("range")).agg(*figures).collect()
    return {r["range"]: tuple(r)[1:] for r in found}


def _in_order(df: DataFrame, keys: Sequence[str], cuts: set[tuple]) -> list[tuple]:
    """Some keys in Spark's order, which alone knows how its types compare."""
    if not cuts:
        return []
    rows = df.sparkSession.createDataFrame(list(cuts), key_schema(df, keys))
    return [as_key(r) for r in rows.orderBy(*keys).collect()]
