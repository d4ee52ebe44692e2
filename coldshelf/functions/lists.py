"""Escaped comma lists: a group's values as text, and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.operators.chunks import multiply, stage_in_order
from coldshelf.plans.staging import broadcast_if_few, stage


def escape_item(item: Column) -> Column:
    """Backslash and comma escaped; NULL is ``\\N``."""
    text = F.replace(F.replace(item, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,"))
    return F.coalesce(text, F.lit("\\N"))


def serialize_array(items: Column) -> Column:
    """One escaped list; ``\\E`` tells a single empty item from an empty list."""
    lone_empty = (F.size(items) == 1) & F.coalesce(F.get(items, F.lit(0)) == "", F.lit(False))
    return F.when(lone_empty, F.lit("\\E")).otherwise(
        F.array_join(F.transform(items, escape_item), ",")
    )


def deserialize_array(text: Column) -> Column:
    """The items of an escaped list, by literal replacements only (linear in length)."""
    mark = "\u0001"
    coded = text
    for plain, code in ((mark, "A"), ("\\\\", "B"), ("\\,", "C")):
        coded = F.replace(coded, F.lit(plain), F.lit(mark + code))

    def restore(item: Column) -> Column:
        out = item
        for code, char in (("B", "\\"), ("C", ","), ("A", mark)):
            out = F.replace(out, F.lit(mark + code), F.lit(char))
        return F.when(item != "\\N", out)

    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(text == "\\E", F.array(F.lit("")))
        .otherwise(F.transform(F.split(coded, ",", -1), restore))
    )


def group_serialize(
    df: DataFrame,
    by: Sequence[str],
    col: str,
    order: Sequence[str],
    max_items: int = 10_000,
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """Each group's values in order as escaped lists: ``(*by, part, first_pos, n_items, items)``.

    A list holds at most ``max_items`` values, and at most ``max_bytes`` bytes unless a
    single value is longer.  A larger group gives several parts, in order, so no group has
    to fit into one task: ``part`` counts from 0 and ``first_pos`` is the place of the
    part's first value in its group, from 1.
    """
    value = F.col(col).cast("string")
    # a value and its comma; escaping can double a text
    length = F.coalesce(F.octet_length(value), F.lit(1)).cast("long") * 2 + 1
    rows = df.select(
        *by, value.alias("_value"), F.struct(*[F.col(c) for c in order], value).alias("_order")
    )
    sizes = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_size"), F.sum(length).alias("_bytes"), F.max(length).alias("_longest")
    )
    per_part = F.greatest(F.lit(1), F.least(F.lit(max_items), F.expr(f"{int(max_bytes)} DIV _longest")))
    large = stage(
        sizes.where((F.col("_size") > max_items) | (F.col("_bytes") > max_bytes)).select(
            *by, per_part.cast("long").alias("_per")
        ),
        "large",
    )
    if large.isEmpty():
        return _collect(rows.withColumn("part", F.lit(0).cast("long")), by)

    named = large.select(*[F.col(c).alias(f"_l{i}") for i, c in enumerate(by)], "_per")
    names = broadcast_if_few(named.drop("_per"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_l{i}")) for i, c in enumerate(by)])
    small = rows.join(names, same, "left_anti").withColumn("part", F.lit(0).cast("long"))

    folded = (
        rows.join(names, same, "left_semi")
        .groupBy(*by, "_order", "_value")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    placed = stage_in_order(folded, [*by, "_order"], "_copies").rows
    begins = stage(
        placed.groupBy(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(by)]).agg(
            F.min("_start").alias("_begin")
        ),
        "begins",
    )
    of_group = reduce(Column.__and__, [F.col(f"_b{i}").eqNullSafe(F.col(f"_l{i}")) for i in range(len(by))])
    begins = stage(begins.join(named, of_group).drop(*[f"_l{i}" for i in range(len(by))]), "begins")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(by)])
    placed = placed.join(broadcast_if_few(begins), same)
    placed = placed.withColumn("_at", F.col("_start") - F.col("_begin"))
    spread = _split_copies(placed, F.col("_per"))
    parts = (
        spread.groupBy(*by, "part")
        .agg(
            (F.min("_at") + 1).alias("first_pos"),
            F.sum("_n").alias("n_items"),
            F.sort_array(F.collect_list(F.struct("_at", "_value", "_n"))).alias("_runs"),
        )
        .withColumn(
            "_items",
            F.flatten(F.transform("_runs", lambda r: F.array_repeat(r["_value"], r["_n"].cast("int")))),
        )
        .select(*by, "part", "first_pos", "n_items", serialize_array(F.col("_items")).alias("items"))
    )
    return _collect(small, by).unionByName(parts)


def _split_copies(placed: DataFrame, size: Column) -> DataFrame:
    """Cut runs of equal values at the borders of parts."""
    last = F.col("_at") + F.col("_copies") - 1
    runs = multiply(placed, F.floor(F.col("_at") / size), F.floor(last / size), "part")
    begin = F.greatest(F.col("_at"), F.col("part") * size)
    end = F.least(last + 1, (F.col("part") + 1) * size)
    return runs.withColumn("_n", end - begin).withColumn("_at", begin)


def _collect(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    collected = rows.groupBy(*by, "part").agg(
        F.sort_array(F.collect_list(F.struct("_order", "_value"))).alias("_rows")
    )
    return collected.select(
        *by,
        "part",
        F.lit(1).cast("long").alias("first_pos"),
        F.size("_rows").cast("long").alias("n_items"),
        serialize_array(F.col("_rows._value")).alias("items"),
    )


def explode_serialized(
    df: DataFrame, col: str, item: str = "item", first_pos: str | None = None
) -> DataFrame:
    """One row per item of an escaped list, with its position ``pos`` from 1.

    Where a list is a part of a longer one, the column ``first_pos`` says at which place
    it begins; it is not in the result, and ``pos`` counts through all parts.
    """
    others = [c for c in df.columns if c not in (col, first_pos)]
    begin = F.col(first_pos).cast("long") if first_pos else F.lit(1).cast("long")
    items = df.select(*others, begin.alias("_begin"), F.posexplode(deserialize_array(F.col(col))).alias("_pos", item))
    return items.select(*others, (F.col("_begin") + F.col("_pos")).alias("pos"), item)
