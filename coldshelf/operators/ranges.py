"""Ranges of a table's keys: where to cut, and which range a row falls into.

Ranges are half open, in ascending order with NULLS FIRST.  Cuts only decide how even
ranges are, so a bounded sample may choose them; counts and checksums per range come from
all rows, are combined in each task, and move no keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldshelf.operators.predicates import keyset_predicate

Key = tuple[Any, ...]
SAMPLED = 40  # sampled keys for each range that is wanted


def key_cuts(df: DataFrame, keys: Sequence[str], parts: int, seed: int = 11) -> list[Key]:
    """At most ``parts - 1`` distinct keys that cut a table into about equal ranges.

    They come from a sample of about ``SAMPLED`` keys a range.
    """
    total, wanted = df.count(), parts * SAMPLED
    rows = df.select(*keys)
    if total > wanted:
        rows = rows.sample(min(1.0, wanted / total), seed=seed)
    found = [as_key(r) for r in rows.orderBy(*keys).collect()]
    cuts = [found[len(found) * i // parts] for i in range(1, parts)] if found else []
    return list(dict.fromkeys(cuts))


def as_key(row: Sequence[Any]) -> Key:
    return tuple(bytes(v) if isinstance(v, bytearray) else v for v in row)


def range_of(df: DataFrame, keys: Sequence[str], cuts: Sequence[Key]) -> Column:
    """The number of cuts at or before a row's key, found by bisection."""
    if not cuts:
        return F.lit(0)
    kinds = [df.schema[k].dataType for k in keys]

    def tuple_of(values: Sequence[Any]) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, kinds))])

    sorted_cuts = F.array(*[tuple_of(c) for c in cuts])
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    halves = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def step(at: Column, half: Column) -> Column:
        further = (at + half <= len(cuts)) & (F.get(sorted_cuts, at + half - 1) <= key)
        return F.when(further, at + half).otherwise(at)

    return F.aggregate(F.array(*[F.lit(h) for h in halves]), F.lit(0), step)


Range = tuple[Key | None, Key | None]  # from, up to; None where it is open


def ranges_between(cuts: Sequence[Key]) -> list[Range]:
    edges = [None, *cuts, None]
    return list(zip(edges, edges[1:]))


def in_ranges(df: DataFrame, keys: Sequence[str], ranges: Sequence[Range]) -> DataFrame:
    """The rows of some ranges, by seeks that a scan understands."""

    def inside(low: Key | None, high: Key | None) -> list[Column]:
        from_low = [] if low is None else [keyset_predicate(keys, low, ">=")]
        return from_low + ([] if high is None else [keyset_predicate(keys, high, "<")])

    wanted = [inside(*r) for r in ranges]
    if not wanted:
        return df.limit(0)
    if any(not conditions for conditions in wanted):
        return df
    return df.where(reduce(Column.__or__, [reduce(Column.__and__, conditions) for conditions in wanted]))


def join_ranges(numbers: Sequence[int], edges: Sequence[Range], most: int) -> list[Range]:
    """Neighbouring ranges as one; where there are more than ``most``, also across the
    narrowest gaps between them."""
    runs: list[list[int]] = []
    for n in sorted(numbers):
        if runs and n == runs[-1][1] + 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    while len(runs) > most:
        gap = min(range(len(runs) - 1), key=lambda i: runs[i + 1][0] - runs[i][1])
        runs[gap : gap + 2] = [[runs[gap][0], runs[gap + 1][1]]]
    return [(edges[a][0], edges[b][1]) for a, b in runs]


def key_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])
