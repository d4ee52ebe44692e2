"""Joining rows to groups of which some may hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_GROUPS = 2000  # no more groups than this can hold one row in so many


def is_hot(size: str, total: int) -> Column:
    return F.col(size) * HOT_GROUPS >= F.lit(total)


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int) -> DataFrame:
    """Left join of ``rows`` to the group that each belongs to, if any.

    ``groups`` holds each key tuple once, ``size`` how many of the ``total`` rows have it;
    keys are not null.  Groups of one row in 2000 or more are at most 2000, whatever the
    size of the table: these are broadcast, so their rows stay where they are.  All other
    rows meet their groups by a shuffle, in which no key has more than that share.  Both
    sides are read twice, so they should be staged.
    """
    keys = list(keys)
    large = groups.where(is_hot(size, total))
    hot = rows.join(F.broadcast(large), keys)
    others = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti")
    rest = others.join(groups.where(~is_hot(size, total)), keys, "left")
    return hot.unionByName(rest)
