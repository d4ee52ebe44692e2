"""Choosing rows: archive predicates, multi-column seeks and literal text matches.

Orders are ascending with NULLS FIRST throughout, which is also Spark's default.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.plans.staging import stage

Predicate = str | Column


def as_column(where: Predicate) -> Column:
    return F.expr(where) if isinstance(where, str) else where


def is_match(where: Predicate) -> Column:
    """TRUE where the predicate holds, FALSE where it is false or NULL."""
    return F.coalesce(as_column(where), F.lit(False))


def complete_columns(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """The wanted columns followed by the key columns they lack."""
    return [*columns, *(k for k in keys if k not in columns)]


def archive_select(
    df: DataFrame,
    where: Predicate,
    columns: Sequence[str] | None = None,
    primary_key_only: bool = False,
    keys: Sequence[str] = (),
    with_keys: bool = False,
) -> DataFrame:
    """The rows to archive, limited to ``columns`` (or to the key columns).

    ``with_keys`` keeps the key columns that had to be added for locating rows; they
    are appended after the wanted ones.
    """
    if isinstance(where, str) and not where.strip():
        raise ValueError("a where predicate is required")
    if primary_key_only and not keys:
        raise ValueError("primary_key_only needs keys")
    wanted = list(keys) if primary_key_only else list(columns or df.columns)
    out = complete_columns(wanted, keys) if with_keys else wanted
    return df.where(as_column(where)).select(*out)


def archive_split(
    df: DataFrame, where: Predicate, deterministic: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(archived, kept)``: rows where the predicate is TRUE, and all the others.

    Together the two hold every input row once.  The archived side filters by the bare
    predicate, which reaches the Parquet scan.  A predicate that may change between
    evaluations (``rand()``, ``current_timestamp()``, a look into another table) is
    evaluated once and the tagged rows are staged; ``deterministic`` overrules what the
    analysed predicate says of itself.
    """
    if deterministic is None:
        deterministic = is_stable(df, where)
    if deterministic:
        return df.where(as_column(where)), df.where(~is_match(where))
    tagged = stage(df.withColumn("_tag", is_match(where)), "split")
    return tagged.where("_tag").drop("_tag"), tagged.where("NOT _tag").drop("_tag")


_BY_CLOCK = re.compile(r"\b(current_(timestamp|date|time)|now|localtimestamp|curdate|unix_timestamp)\(\)")


def is_stable(df: DataFrame, where: Predicate) -> bool:
    """Does the predicate give the same answer whenever it is evaluated?"""
    plan = df.where(as_column(where))._jdf.queryExecution().analyzed()
    found = plan.expressions()
    subquery = df.sparkSession._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression
    for i in range(found.size()):
        expression = found.apply(i)
        if not expression.deterministic() or subquery.hasSubquery(expression):
            return False
        if _BY_CLOCK.search(expression.toString().lower()):
            return False
    return True


def purge(df: DataFrame, where: Predicate) -> DataFrame:
    """What remains after deleting the matching rows without copying them."""
    return df.where(~is_match(where))


def copy_only(df: DataFrame, where: Predicate) -> DataFrame:
    """The matching rows, copied without deleting them."""
    return df.where(as_column(where))


def enum_ordinal(column: Column, members: Sequence[str]) -> Column:
    """1-based position among the declared members; 0 for a value not declared."""
    return F.array_position(F.array(*[F.lit(m) for m in members]), column)


def _before(column: Column, value: Any) -> Column:
    return F.lit(False) if value is None else (column < F.lit(value)) | column.isNull()


def _after(column: Column, value: Any) -> Column:
    return column.isNotNull() if value is None else column > F.lit(value)


def _same(column: Column, value: Any) -> Column:
    return column.isNull() if value is None else column.eqNullSafe(F.lit(value))


def _beside_member(column: Column, value: str | None, members: list[str], down: bool) -> tuple[Column, Column]:
    """Values before or after a member, and those equal to it, as sets that a scan knows.

    Values that are no members come before all members and are equal to each other.
    """
    at = members.index(value) + 1 if value in members else 0
    undeclared = column.isNotNull() & ~column.isin(members) if members else column.isNotNull()
    if value is None:
        return F.lit(False) if down else column.isNotNull(), column.isNull()
    same = column == value if at else undeclared
    if not down:
        return column.isin(members[at:]) if members[at:] else F.lit(False), same
    if not at:
        return column.isNull(), same
    return column.isNull() | ~column.isin(members[at - 1 :]), same


def keyset_predicate(
    keys: Sequence[str],
    boundary: Sequence[Any] | Mapping[str, Any],
    op: str = ">=",
    first_n_keys: int | None = None,
    strict: bool = False,
    enums: Mapping[str, Sequence[str]] | None = None,
) -> Column:
    """Rows before or after a key tuple, as a condition Parquet and JDBC can use.

    The expanded OR form is deliberate: a comparison of structs gives the same answer
    but is not pushed into the scan.
    """
    if op not in ("<", "<=", ">=", ">"):
        raise ValueError(f"unknown comparison {op!r}")
    if not keys:
        raise ValueError("at least one key column is required")
    values = [boundary[k] for k in keys] if isinstance(boundary, Mapping) else list(boundary)
    count = min(first_n_keys or len(keys), len(keys))
    if len(values) < count:
        raise ValueError(f"boundary has {len(values)} values for {count} keys")

    down = op.startswith("<")
    branches = []
    equal: list[Column] = []
    for key, value in list(zip(keys, values))[:count]:
        column, members = F.col(key), (enums or {}).get(key)
        if members is None:
            beyond, same = (_before if down else _after)(column, value), _same(column, value)
        else:
            beyond, same = _beside_member(column, value, list(members), down)
        branches.append(reduce(Column.__and__, [*equal, beyond]))
        equal.append(same)
    if op.endswith("=") and not strict:
        branches.append(reduce(Column.__and__, equal))
    return reduce(Column.__or__, branches)


def keyset_filter(
    df: DataFrame,
    keys: Sequence[str],
    boundary: Sequence[Any] | Mapping[str, Any],
    op: str = ">=",
    first_n_keys: int | None = None,
    strict: bool = False,
    enums: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows lexicographically before or after a key tuple.

    ``first_n_keys`` compares only the leading keys (a number beyond the key count is
    ignored); ``strict`` leaves out the boundary itself.
    """
    return df.where(keyset_predicate(keys, boundary, op, first_n_keys, strict, enums))


def escape_like(text: str, escape: str = "\\") -> str:
    """Text as a LIKE pattern that matches exactly this text, for use in SQL."""
    for special in (escape, "%", "_"):
        text = text.replace(special, escape + special)
    return text


def filter_literal(df: DataFrame, col: str, text: str, how: str = "equals") -> DataFrame:
    """Match text literally even where it holds ``%`` or ``_``.

    ``how``: ``equals``, ``prefix``, ``suffix`` or ``contains``.  These need no pattern,
    so they reach the scan where a LIKE with escapes would not.
    """
    column, value = F.col(col), F.lit(text)
    tests = {
        "equals": column == value,
        "prefix": column.startswith(value),
        "suffix": column.endswith(value),
        "contains": column.contains(value),
    }
    return df.where(tests[how])
