"""Moving rows between tables: deletes by key, inserts with conflict rules, appends.

Joins that only test for presence get a right side reduced to distinct keys first, so a
key repeated many times there costs one row per map task.  A repeated key on the left is
split by Spark's adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.operators.chunks import multiply
from coldshelf.plans.staging import is_few, stage

JoinKeys = Sequence[str] | Mapping[str, str]


def _null_in(keys: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(k).isNull() for k in keys])


def _renamed_keys(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Distinct key tuples of ``df`` under names that cannot clash with the other side."""
    names = [f"_k{i}" for i in range(len(columns))]
    return df.select(*[F.col(c).alias(n) for c, n in zip(columns, names)]).distinct(), names


def purge_orphans(child: DataFrame, parent: DataFrame, on: JoinKeys) -> tuple[DataFrame, DataFrame]:
    """``(orphans, kept)``: child rows without and with a parent row.

    ``on`` maps child columns to parent columns (or lists columns of equal name).  As
    with NOT EXISTS, a NULL key has no parent and makes the row an orphan.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    orphans = _without(child, parent, list(pairs), list(pairs.values()))
    present = parent.where(~_null_in(list(pairs.values())))
    keys, names = _renamed_keys(present, list(pairs.values()))
    match = reduce(Column.__and__, [F.col(c) == F.col(n) for c, n in zip(pairs, names)])
    return orphans, child.join(keys, match, "left_semi")


def delete_rows(
    df: DataFrame, locators: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Remove the rows named by key tuples; NULL matches NULL.

    Without a unique key the match is on all columns.
    """
    columns = list(keys or df.columns)
    named, names = _renamed_keys(locators, columns)
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(columns, names)])
    return df.join(named, match, "left_anti")


def delete_rows_exact(df: DataFrame, archived: DataFrame) -> DataFrame:
    """Remove exactly as many copies of each row as were archived.

    The multiset difference is counted per distinct row with map-side combining, and the
    remaining copies are written out again in blocks, so many copies of one row neither
    travel nor end up in a single task.  If few distinct rows were archived, all other
    rows pass by a broadcast of these without a shuffle.
    """
    columns = df.columns
    gone = stage(
        archived.select(*columns).groupBy(*columns).agg((-F.count(F.lit(1))).alias("_n")), "gone"
    )
    if not is_few(gone):
        return _subtract(df, gone)
    names = [f"_k{i}" for i in range(len(columns))]
    known = F.broadcast(gone.select(*[F.col(c).alias(n) for c, n in zip(columns, names)]))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(columns, names)])
    others = df.join(known, same, "left_anti")
    return others.unionByName(_subtract(df.join(known, same, "left_semi"), gone))


def _subtract(df: DataFrame, gone: DataFrame) -> DataFrame:
    """``df`` without as many copies of each row as ``gone`` counts, below zero, in ``_n``."""
    columns = df.columns
    signed = df.withColumn("_n", F.lit(1).cast("long")).unionByName(gone)
    left = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n > 0")
    one = F.lit(1).cast("long")
    return multiply(left, one, F.col("_n"), "_copy").select(*columns)


def _first_per_key(
    rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool
) -> DataFrame:
    """One row per key; the ordering is completed by the remaining columns."""
    order = [*order_by, *(c for c in rows.columns if c not in order_by)]
    pick = F.max_by if last else F.min_by
    row = pick(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    return rows.groupBy(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)]).agg(row).select("_row.*")


def _key_lists(keys: Sequence[str] | Sequence[Sequence[str]]) -> list[list[str]]:
    if not keys:
        raise ValueError("at least one unique key is required")
    return [list(keys)] if isinstance(keys[0], str) else [list(k) for k in keys]


def _without(
    df: DataFrame, other: DataFrame, keys: Sequence[str], other_keys: Sequence[str] | None = None
) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; a key with a NULL never is.

    Rows with a NULL in the key skip the join: they would all meet in one task.
    """
    there = list(other_keys or keys)
    named, names = _renamed_keys(other.where(~_null_in(there)), there)
    match = reduce(Column.__and__, [F.col(c) == F.col(n) for c, n in zip(keys, names)])
    unmatched = df.where(~_null_in(keys)).join(named, match, "left_anti")
    return unmatched.union(df.where(_null_in(keys)))


def settle(
    incoming: DataFrame, unique_keys: list[list[str]], order_by: Sequence[str], last: bool
) -> DataFrame:
    """Incoming rows after conflicts among themselves are resolved."""
    if len(unique_keys) == 1:
        keys = unique_keys[0]
        free = incoming.where(_null_in(keys))
        keyed = incoming.where(~_null_in(keys))
        return free.unionByName(_first_per_key(keyed, keys, order_by, last))
    for keys in unique_keys:
        repeated = incoming.where(~_null_in(keys)).groupBy(*keys).count().where("count > 1")
        if not repeated.isEmpty():
            raise ValueError(
                f"incoming rows conflict with each other on {keys}; with several unique "
                "keys the outcome depends on the order of single inserts"
            )
    return incoming


def new_rows(
    dest: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] | Sequence[Sequence[str]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The incoming rows an INSERT IGNORE would add; the first in ``order_by`` wins."""
    unique_keys = _key_lists(keys)
    rows = incoming.select(*dest.columns)
    for key in unique_keys:
        rows = _without(rows, _present(dest, rows, key), key)
    return settle(rows, unique_keys, order_by, last=False)


def _present(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``table`` that occur in ``rows``.

    A table is mostly much larger than what is added to it; this way round, a batch with
    few keys is broadcast and the table's keys are not shuffled.
    """
    named, names = _renamed_keys(rows.where(~_null_in(keys)), keys)
    match = reduce(Column.__and__, [F.col(c) == F.col(n) for c, n in zip(keys, names)])
    return table.select(*keys).join(named, match, "left_semi")


def insert_ignore(
    dest: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] | Sequence[Sequence[str]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``dest`` plus the incoming rows that conflict with no row of it.

    ``keys`` is one unique key, or a list of several.
    """
    return dest.unionByName(new_rows(dest, incoming, keys, order_by))


def replace_into(
    dest: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] | Sequence[Sequence[str]],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``dest`` with conflicting rows replaced; the last in ``order_by`` wins."""
    unique_keys = _key_lists(keys)
    rows = settle(incoming.select(*dest.columns), unique_keys, order_by, last=True)
    kept = dest
    for key in unique_keys:
        kept = _without(kept, rows, key)
    return kept.unionByName(rows)


def append_common(dest: DataFrame, src: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Append the source columns that exist in ``dest``; the others become NULL there."""
    offered = list(src.columns if columns is None else columns)
    if not offered:
        raise ValueError("no source columns given")
    return dest.unionByName(
        src.select(*common_columns(dest, offered)), allowMissingColumns=True
    )


def common_columns(dest: DataFrame, offered: Sequence[str]) -> list[str]:
    """Offered columns that exist in ``dest``, in the offered order."""
    return [c for c in offered if c in dest.columns]
