"""Table and column statistics, auto-increment safety and counter deltas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from coldshelf.operators.chunks import multiply, stage_in_order
from coldshelf.operators.compare import checksum as checksum_of
from coldshelf.operators.compare import row_pieces
from coldshelf.plans.staging import broadcast_if_few, stage


def _stored_length(field: T.StructField) -> Column:
    """Bytes of one value: the type's width, or the octets of text; 0 for NULL."""
    widths = {
        "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
        "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
    }
    column = F.col(field.name)
    name = field.dataType.simpleString()
    if name in widths:
        size = F.lit(widths[name])
    elif isinstance(field.dataType, T.DecimalType):
        size = F.lit(8 if field.dataType.precision <= 18 else 16)
    elif isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    else:
        size = F.octet_length(F.to_json(F.struct(column)))
    return F.when(column.isNotNull(), size).otherwise(0).cast("long")


def table_status(
    df: DataFrame,
    name: str,
    autoinc_col: str | None = None,
    update_col: str | None = None,
    checksum: bool = False,
) -> DataFrame:
    """One profile row of a table, in one pass; NULL where a figure is not known."""
    length = sum((_stored_length(f) for f in df.schema.fields), F.lit(0).cast("long"))
    none = F.lit(None)
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(length), F.lit(0).cast("long")).alias("data_length"),
        ((F.max(autoinc_col) + 1) if autoinc_col else none).cast("long").alias("auto_increment"),
        (F.min(update_col) if update_col else none.cast("timestamp_ntz")).alias("first_update"),
        (F.max(update_col) if update_col else none.cast("timestamp_ntz")).alias("last_update"),
        (checksum_of(row_pieces(df.columns)) if checksum else none.cast("decimal(38,0)")).alias("checksum"),
    )
    return totals.select(
        F.lit(name).alias("name"),
        "n_rows",
        F.expr("CASE WHEN n_rows > 0 THEN data_length DIV n_rows END").alias("avg_row_length"),
        "data_length",
        "auto_increment",
        "first_update",
        "last_update",
        "checksum",
    )


def analyze_columns(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest value as text.

    Exact figures come from counting each column's values: every column is read once,
    and its values are combined before they are shuffled.  ``exact_distinct=False`` uses
    a sketch instead, one pass over all columns that shuffles no values at all.
    """
    if exact_distinct:
        return reduce(DataFrame.unionByName, [_analyze_exactly(df, c) for c in df.columns])
    columns = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.struct(
                F.count(c).alias("filled"),
                F.approx_count_distinct(c).alias("n_distinct"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            ).alias(f"_c{i}")
            for i, c in enumerate(columns)
        ],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"_c{i}").alias("s")) for i, c in enumerate(columns)
    ]
    return wide.select("_rows", F.explode(F.array(*entries)).alias("e")).select(
        "e.column",
        F.col("_rows").alias("n_rows"),
        (F.col("_rows") - F.col("e.s.filled")).alias("n_nulls"),
        "e.s.n_distinct",
        "e.s.min_value",
        "e.s.max_value",
    )


def _analyze_exactly(df: DataFrame, column: str) -> DataFrame:
    values = df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("long")
    return values.agg(
        F.coalesce(F.sum("n"), none).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), none).alias("n_nulls"),
        F.count("v").alias("n_distinct"),
        F.min("v").cast("string").alias("min_value"),
        F.max("v").cast("string").alias("max_value"),
    ).select(F.lit(column).alias("column"), "*")


def analyze_table(df: DataFrame, table: str) -> None:
    """Refresh the catalog's statistics of a saved table for the optimizer."""
    df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def keep_latest_autoinc(
    df: DataFrame, autoinc_col: str, archived: DataFrame, enabled: bool = True
) -> DataFrame:
    """``archived`` without the row that holds the table's largest auto-increment value.

    Were that row removed, a restarted server could hand its number out again.
    """
    if not enabled:
        return archived
    return archived.where(below_latest(df, autoinc_col))


def below_latest(df: DataFrame, autoinc_col: str) -> Column:
    """Condition that spares the row with the largest auto-increment value of ``df``."""
    largest = df.agg(F.max(autoinc_col).alias("m")).scalar()
    return F.col(autoinc_col) < largest


def _micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970; a time without zone is taken as it is, not by session zone."""
    if not isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.unix_micros(F.col(ts).cast("timestamp"))
    since = F.col(ts) - F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    part = lambda unit: F.extract(F.lit(unit), since)
    minutes = (part("DAY").cast("long") * 24 + part("HOUR")) * 60 + part("MINUTE")
    return minutes * 60_000_000 + (part("SECOND") * 1_000_000).cast("long")


def counter_deltas(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    counters: Sequence[str],
    max_group: int = 1_000_000,
) -> DataFrame:
    """Difference and rate per second of counters against the device's previous sample.

    The first sample of a device and a counter that went backwards (a reset) give NULL;
    samples without a time come first.  Devices with more than ``max_group`` samples are
    cut into spans of that many, and the last sample of each span is carried to the first
    of the next, which gives the same result for every ``max_group``.
    """
    timed = df.withColumn("_us", _micros(df, ts))
    sample = F.struct("_us", *counters)
    sizes = timed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(sizes.where(F.col("_n") > max_group).drop("_n"), "hot")
    window = W.partitionBy(*by).orderBy("_us", *counters)
    if hot.isEmpty():
        rows = timed.withColumn("_prev", F.lag(sample).over(window))
    else:
        names = [f"_d{i}" for i in range(len(by))]
        devices = broadcast_if_few(hot.select(*[F.col(c).alias(n) for c, n in zip(by, names)]))
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)])
        others = timed.join(devices, same, "left_anti").withColumn("_prev", F.lag(sample).over(window))
        spans = _carried_samples(timed.join(devices, same, "left_semi"), by, counters, max_group)
        rows = others.unionByName(spans)

    seconds = (F.col("_us") - F.col("_prev._us")) / F.lit(1e6)
    out = [F.col(c) for c in df.columns]
    for c in counters:
        delta = F.col(c) - F.col(f"_prev.{c}")
        delta = F.when(delta >= 0, delta)
        out += [
            delta.alias(f"{c}_delta"),
            F.when(seconds > 0, delta / seconds).alias(f"{c}_rate"),
        ]
    return rows.select(*out)


def _carried_samples(
    timed: DataFrame, by: Sequence[str], counters: Sequence[str], max_group: int
) -> DataFrame:
    """Samples of hot devices with the previous one as ``_prev``.

    All samples are put in order over the cluster, and each device's are cut by their
    place, so a span has ``max_group`` samples however they lie in time.
    """
    sample = F.struct("_us", *counters)
    rest = [c for c in timed.columns if c not in {*by, "_us", *counters}]
    order = [*by, "_us", *counters, *rest]
    folded = timed.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies"))
    placed = stage_in_order(folded, order, "_copies")
    numbered = placed.rows.withColumn("_place", F.col("_start"))
    if not placed.single:
        numbered = multiply(placed.rows, F.col("_start"), F.col("_start") + F.col("_copies") - 1, "_place")
    numbered = stage(numbered.withColumn("_span", F.expr(f"_place DIV {int(max_group)}")), "spans")

    in_span = W.partitionBy(*by, "_span").orderBy("_place")
    rows = numbered.withColumn("_prev", F.lag(sample).over(in_span)).withColumn(
        "_head", F.row_number().over(in_span) == 1
    )
    names = [f"_d{i}" for i in range(len(by))]
    tails = numbered.groupBy(*by, "_span").agg(F.max_by(sample, "_place").alias("_tail"))
    carried = tails.select(
        *[F.col(c).alias(n) for c, n in zip(by, names)],
        F.col("_span").alias("_for"),
        F.lag("_tail").over(W.partitionBy(*by).orderBy("_span")).alias("_carried"),
    )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)])
    return (
        rows.join(carried, same & (F.col("_span") == F.col("_for")), "left")
        .withColumn("_prev", F.when(F.col("_head"), F.col("_carried")).otherwise(F.col("_prev")))
        .select(*timed.columns, "_prev")
    )
