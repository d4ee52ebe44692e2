"""Checks across tables: foreign keys, presence in a catalog, equal columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    child_cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]


def foreign_keys_of(catalog: DataFrame, child_names: DataFrame) -> list[ForeignKey]:
    """The foreign keys that a catalog of column pairs describes.

    ``catalog`` is what ``ddl_foreign_keys`` gives, ``child_names`` what ``ddl_tables`` gives
    for the same texts (``src_id`` and the table's ``name``).  A key of several columns is one
    key, its pairs in their order.  The catalog is as small as the schema it describes.
    """
    pair = F.struct("pos", "child_col", "parent_col")
    keys = (
        catalog.join(child_names.select("src_id", F.col("name").alias("child")), "src_id")
        .groupBy("src_id", "child", "fk_name", "parent_table")
        .agg(F.sort_array(F.collect_list(pair)).alias("pairs"))
        .orderBy("src_id", "fk_name")
    )
    return [
        ForeignKey(
            r["fk_name"], r["child"], tuple(p["child_col"] for p in r["pairs"]),
            r["parent_table"], tuple(p["parent_col"] for p in r["pairs"]),
        )
        for r in keys.collect()
    ]


def fk_integrity(tables: Mapping[str, DataFrame], foreign_keys: Sequence[ForeignKey]) -> DataFrame:
    """Per foreign key: child rows, rows with a NULL in the key, rows without a parent.

    Each table is read once, whatever number of keys it has a part in: a row gives one key
    tuple for every key of which its table is the child or the parent.  Tuples are counted
    before they are shuffled, and child and parent meet in the count, not in a join.
    """
    numbered = list(enumerate(foreign_keys))
    kinds = [_common_types(tables, fk) for fk in foreign_keys]
    scans = []
    for name in dict.fromkeys(t for fk in foreign_keys for t in (fk.child, fk.parent)):
        table = tables[name]
        roles = [_role(i, table, fk.child_cols, kinds[i], 1) for i, fk in numbered if fk.child == name]
        roles += [_role(i, table, fk.parent_cols, kinds[i], 0) for i, fk in numbered if fk.parent == name]
        scans.append(table.select(F.explode(F.array(*roles)).alias("r")).select("r.*"))
    tuples = (
        reduce(DataFrame.unionByName, scans)
        .groupBy("fk_no", "key")
        .agg(F.sum("in_child").alias("n"), F.min("in_child").alias("least"))
    )
    # a key that contains a NULL is none; one that only children have has no parent
    figures = tuples.groupBy("fk_no").agg(
        F.sum("n").alias("child_rows"),
        F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("null_rows"),
        F.sum(F.when(F.col("key").isNotNull() & (F.col("least") == 1), F.col("n")).otherwise(0)).alias("orphan_rows"),
    )
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(i, fk.name) for i, fk in numbered], "fk_no int, fk string")
    zero = F.lit(0).cast("long")
    return names.join(figures, "fk_no", "left").select(
        "fk", *[F.coalesce(c, zero).alias(c) for c in ("child_rows", "null_rows", "orphan_rows")]
    )


def _common_types(tables: Mapping[str, DataFrame], fk: ForeignKey) -> list[T.DataType]:
    """Per column the type in which child and parent are compared."""
    child, parent = tables[fk.child], tables[fk.parent]
    pairs = [(child.schema[c].dataType, parent.schema[p].dataType) for c, p in zip(fk.child_cols, fk.parent_cols, strict=True)]
    both = [F.coalesce(F.lit(None).cast(x), F.lit(None).cast(y)).alias(f"c{i}") for i, (x, y) in enumerate(pairs)]
    return [f.dataType for f in child.sparkSession.range(0).select(*both).schema.fields]


def _role(number: int, table: DataFrame, columns: Sequence[str], kinds: Sequence[T.DataType], in_child: int) -> Column:
    """A row's key tuple in one foreign key, as texts so that all keys have one type."""

    def text(column: str, kind: T.DataType) -> Column:
        value = F.col(column).cast(kind)
        return F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")

    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    key = F.when(whole, F.array(*[text(c, k) for c, k in zip(columns, kinds)]))
    return F.struct(F.lit(number).alias("fk_no"), key.alias("key"), F.lit(in_child).cast("long").alias("in_child"))


def tables_present(
    wanted: DataFrame, catalog: DataFrame, lower_case_names: bool = False
) -> DataFrame:
    """``wanted(db, tbl)`` with ``present``: is the pair in ``catalog(db, tbl)``?"""
    fold = F.lower if lower_case_names else (lambda c: c)
    known = (
        catalog.select(fold(F.col("db")).alias("_db"), fold(F.col("tbl")).alias("_tbl"))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    match = (fold(F.col("db")) == F.col("_db")) & (fold(F.col("tbl")) == F.col("_tbl"))
    return wanted.join(known, match, "left").select(
        *wanted.columns, F.coalesce("_hit", F.lit(False)).alias("present")
    )


def check_columns(a: DataFrame, b: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Differences between two column catalogs ``(*by, name, pos, spark_type)``.

    One row per column that is missing on a side or has another type or position.
    ``by`` names the columns that identify a table where a catalog holds many.
    """
    left = a.select(*by, "name", F.col("pos").alias("pos_a"), F.col("spark_type").alias("type_a"))
    right = b.select(*by, "name", F.col("pos").alias("pos_b"), F.col("spark_type").alias("type_b"))
    verdict = (
        F.when(F.col("pos_a").isNull(), "missing_in_a")
        .when(F.col("pos_b").isNull(), "missing_in_b")
        .when(~F.col("type_a").eqNullSafe(F.col("type_b")), "type")
        .when(F.col("pos_a") != F.col("pos_b"), "position")
    )
    return (
        left.join(right, [*by, "name"], "full")
        .withColumn("difference", verdict)
        .where(F.col("difference").isNotNull())
    )


def schema_catalog(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column catalog of one DataFrame, from its schema alone."""
    rows = [(f.name, i + 1, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "name string, pos bigint, spark_type string")
