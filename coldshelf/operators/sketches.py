"""Manifests and statistics that grow with a table without reading it again.

Sketches merge: that of a table is the merge of those of its parts.  A manifest's ranges
come from a quantile sketch, made in one pass; its counts are exact, taken in a second pass
that moves one row for each range and task, and no keys.  Statistics are stored per file,
so after an append only new files are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldshelf.operators.ranges import range_of
from coldshelf.operators.swap import flat_files
from coldshelf.plans.staging import path_exists

MAX_RANGES = 1000  # the finest ranges that a sketch of the size used tells apart
_SKETCH_K = 4096

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class RangeManifest:
    """``ranges``: (chunk_id, n_rows, rows_done, lo, hi), exact, in key order; ``sketch``: one
    row with the quantile sketch of the key; ``cuts``: where ranges begin, but the first."""

    ranges: DataFrame
    sketch: DataFrame
    cuts: tuple


def range_manifest(df: DataFrame, key: str, chunk_rows: int) -> RangeManifest:
    """Cut a table by one numeric key into ranges of about ``chunk_rows`` rows.

    There are at most ``MAX_RANGES`` ranges, larger ones if need be.  Rows of one key share
    a range; NULL comes first.
    """
    if chunk_rows < 1:
        raise ValueError("a chunk needs at least one row")
    sketch = _sketch(df, key)
    return RangeManifest(*_counted(df, key, sketch, cuts := _cuts(df, key, sketch, chunk_rows)), cuts)


def extend_manifest(old: RangeManifest, added: DataFrame, key: str) -> RangeManifest:
    """The manifest after rows were added, of which alone anything is read.

    Ranges stay as they are; the first and the last one take what lies beyond them.
    """
    more = range_manifest_at(added, key, old.cuts)
    both = old.ranges.select("chunk_id", "n_rows", "lo", "hi").unionByName(more.ranges.select("chunk_id", "n_rows", "lo", "hi"))
    kind = _kind(added, key)
    merged = old.sketch.unionByName(more.sketch).agg(_call(f"kll_merge_agg_{kind}", "sketch").alias("sketch"))
    return RangeManifest(_in_sum(both), merged, old.cuts)


def range_manifest_at(df: DataFrame, key: str, cuts: Sequence) -> RangeManifest:
    """A manifest with given cuts."""
    sketch = _sketch(df, key)
    return RangeManifest(*_counted(df, key, sketch, tuple(cuts)), tuple(cuts))


def overfull(manifest: RangeManifest, chunk_rows: int) -> DataFrame:
    """Ranges that have grown to more than twice the size wanted: time for new cuts."""
    return manifest.ranges.where(F.col("n_rows") > 2 * chunk_rows)


def _kind(df: DataFrame, key: str) -> str:
    kind = df.schema[key].dataType
    if isinstance(kind, _WHOLE):
        return "bigint"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "double"
    raise ValueError(f"{key} is not numeric; use chunk_manifest")


def _call(name: str, *args) -> Column:
    return getattr(F, name)(*args)


def _sketch(df: DataFrame, key: str) -> DataFrame:
    kind = _kind(df, key)
    value = F.col(key).cast(kind)
    if kind == "double":
        value = F.when(~F.isnan(value), value)
    return df.agg(_call(f"kll_sketch_agg_{kind}", value, F.lit(_SKETCH_K)).alias("sketch"))


def _cuts(df: DataFrame, key: str, sketch: DataFrame, chunk_rows: int) -> tuple:
    kind = _kind(df, key)
    n = sketch.select(_call(f"kll_sketch_get_n_{kind}", "sketch").alias("n")).first()["n"]
    parts = min(MAX_RANGES, -(-(n or 0) // chunk_rows))
    if parts < 2:
        return ()
    ranks = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = sketch.select(_call(f"kll_sketch_get_quantile_{kind}", "sketch", ranks).alias("q")).first()["q"]
    return tuple(dict.fromkeys(found))


def _counted(df: DataFrame, key: str, sketch: DataFrame, cuts: Sequence) -> tuple[DataFrame, DataFrame]:
    keyed = df.select(F.col(key).cast(_kind(df, key)).alias("cut_by"), F.col(key).alias("key"))
    counts = keyed.groupBy(range_of(keyed, ["cut_by"], [(c,) for c in cuts]).alias("chunk_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("key").alias("lo"), F.max("key").alias("hi")
    )
    return _in_sum(counts), sketch


def _in_sum(counts: DataFrame) -> DataFrame:
    """Counts of equal ranges added up, with the rows up to the end of each: a window over
    ranges, of which there are few, not over rows."""
    added = counts.groupBy("chunk_id").agg(F.sum("n_rows").alias("n_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    entry = F.struct("chunk_id", "n_rows", "lo", "hi")
    listed = added.agg(F.sort_array(F.collect_list(entry)).alias("all"))
    each = listed.select(F.posexplode("all").alias("i", "r"), "all")
    done = F.aggregate(F.slice("all", F.lit(1), F.col("i") + 1), F.lit(0).cast("long"), lambda s, r: s + r["n_rows"])
    return each.select(F.col("r.chunk_id").cast("long").alias("chunk_id"), "r.n_rows", done.alias("rows_done"), "r.lo", "r.hi")


# -- statistics per file ---------------------------------------------------------------


def refresh_statistics(spark: SparkSession, path: str, store: str) -> list[str]:
    """Bring the statistics of a table's files, stored at ``store``, up to date.

    Reads the files that are not in the store yet and returns their names; files never
    change, so a name that is known needs no second look.
    """
    known = {r["file"] for r in _stored(spark, store).select("file").collect()} if path_exists(spark, store) else set()
    new = sorted(flat_files(spark, path).keys() - known)
    if new:
        rows = spark.read.parquet(*[f"{path.rstrip('/')}/{n}" for n in new])
        rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.count(F.lit(1)).alias("n_rows"), *[_column_figures(f).alias(f"c_{f.name}") for f in rows.schema.fields]
        ).write.mode("append").parquet(store)
        # files without rows are known as well
        seen = {r["file"] for r in _stored(spark, store).select("file").collect()}
        empty = [(n, 0) for n in new if n not in seen]
        if empty:
            spark.createDataFrame(empty, "file string, n_rows bigint").write.mode("append").parquet(store)
    return new


def table_statistics(spark: SparkSession, path: str, store: str) -> DataFrame:
    """Per column of a table: rows, nulls, estimated distinct values, smallest and largest
    value as text, merged from the store, which is brought up to date first.

    Files that are gone no longer count.
    """
    refresh_statistics(spark, path, store)
    table = spark.read.parquet(path)
    names = spark.createDataFrame([(n,) for n in flat_files(spark, path)], "file string")
    files = _stored(spark, store).join(F.broadcast(names), "file", "left_semi")
    zero = F.lit(0).cast("long")
    merged = files.agg(
        F.coalesce(F.sum("n_rows"), zero).alias("_rows"),
        *[
            F.struct(
                F.coalesce(F.sum(F.col(f"`c_{f.name}`")["filled"]), zero).alias("filled"),
                F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.col(f"`c_{f.name}`")["sketch"])), zero).alias("n_distinct"),
                F.min(F.col(f"`c_{f.name}`")["lo"]).cast("string").alias("min_value"),
                F.max(F.col(f"`c_{f.name}`")["hi"]).cast("string").alias("max_value"),
            ).alias(f"_c{i}")
            for i, f in enumerate(table.schema.fields)
        ],
    )
    entries = [F.struct(F.lit(f.name).alias("column"), F.col(f"_c{i}").alias("s")) for i, f in enumerate(table.schema.fields)]
    return merged.select("_rows", F.explode(F.array(*entries)).alias("e")).select(
        "e.column",
        F.col("_rows").alias("n_rows"),
        (F.col("_rows") - F.col("e.s.filled")).alias("n_nulls"),
        "e.s.n_distinct",
        "e.s.min_value",
        "e.s.max_value",
    )


def _column_figures(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    hashable = column if isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else column.cast("string")
    return F.struct(
        F.count(column).alias("filled"), F.min(column).alias("lo"), F.max(column).alias("hi"),
        F.hll_sketch_agg(hashable).alias("sketch"),
    )


def _stored(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(store)
