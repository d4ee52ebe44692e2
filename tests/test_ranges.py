"""Ranges of keys, comparison by a tree of ranges, and sketches that merge."""

import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from coldshelf.operators import sketches
from coldshelf.operators.compare import compare_rows
from coldshelf.operators.drilldown import drill_down
from coldshelf.operators.integrity import ForeignKey, fk_integrity
from coldshelf.operators.ranges import in_ranges, join_ranges, key_cuts, range_of, ranges_between


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def order(key):
    """Sorts a pair of an int and a text, None first."""
    return [(key[0] is not None, key[0] or 0), (key[1] is not None, key[1] or "")]


@pytest.mark.parametrize("n_cuts", [0, 1, 5, 40])
def test_range_of_a_key(spark, n_cuts):
    r = random.Random(n_cuts)
    pairs = [(a, b) for a in (None, *range(6)) for b in (None, *"0123")]
    rows = [r.choice(pairs) for _ in range(200)]
    cuts = sorted({r.choice(pairs) for _ in range(n_cuts)}, key=order)
    df = spark.createDataFrame(rows, "a int, b string")
    found = df.select("a", "b", range_of(df, ["a", "b"], cuts).alias("n")).collect()
    assert all(x.n == sum(order(c) <= order((x.a, x.b)) for c in cuts) for x in found)
    ranges = ranges_between(cuts)
    for i in {0, len(ranges) // 2, len(ranges) - 1}:
        assert in_ranges(df, ["a", "b"], [ranges[i]]).count() == sum(x.n == i for x in found)


def test_cuts_are_about_even(spark):
    df = spark.range(20_000).selectExpr("id * id AS k")
    cuts = key_cuts(df, ["k"], 10)
    counts = [r["count"] for r in df.groupBy(range_of(df, ["k"], cuts).alias("n")).count().collect()]
    assert len(counts) == 10 and max(counts) < 2 * 2000
    assert key_cuts(df.limit(0), ["k"], 10) == []


def test_joined_ranges():
    edges = ranges_between([(i,) for i in range(9)])
    assert join_ranges([1, 2, 5], edges, 9) == [((0,), (2,)), ((4,), (5,))]
    assert join_ranges([0, 9], edges, 9) == [(None, (0,)), ((8,), None)]
    assert join_ranges([1, 4, 6, 9], edges, 2) == [((0,), (6,)), ((8,), None)]


def pair(spark, seed, n=3000):
    r = random.Random(seed)
    rows = [(i // 3, "x" if i % 11 else None, r.randrange(99)) for i in range(n)]
    other = [x for x in rows if r.random() > 0.002] + [(n + 5, "new", 1), (-4, None, 2)]
    other = [(*x[:2], -1) if r.random() < 0.001 else x for x in other]
    schema = "k int, s string, v int"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)


@pytest.mark.parametrize("leaf, fanout", [(20, 6), (200, 16), (10**6, 256)])
def test_drilling_down_finds_what_a_full_comparison_finds(spark, leaf, fanout):
    a, b = pair(spark, leaf)
    found = drill_down(a, b, ["k", "s"], leaf_rows=leaf, fanout=fanout)
    assert bag(found.rows) == bag(compare_rows(a, b, ["k", "s"]))
    whole = found.levels.where("level = 0").agg(F.sum("rows_a").alias("a"), F.sum("rows_b").alias("b")).first()
    assert (whole.a, whole.b) == (a.count(), b.count())


def test_equal_ranges_are_not_read_again(spark, folder):
    rows = spark.range(50_000).selectExpr("id AS k", "id * 7 AS v")
    rows.repartitionByRange(10, "k").sortWithinPartitions("k").write.parquet(f"{folder}/a")
    rows.selectExpr("k", "IF(k = 31234, -1, v) AS v").repartitionByRange(10, "k").write.parquet(f"{folder}/b")
    a, b = spark.read.parquet(f"{folder}/a"), spark.read.parquet(f"{folder}/b")
    found = drill_down(a, b, ["k"], leaf_rows=100, fanout=8)
    per_level = found.levels.groupBy("level").agg(F.sum("rows_a").alias("a"), F.count_if(F.col("verdict") == "different").alias("bad"))
    read = {r.level: (r.a, r.bad) for r in per_level.collect()}
    assert read[0][0] == 50_000 and len(read) >= 3
    assert all(read[level][0] < read[level - 1][0] / 3 and read[level][1] == 1 for level in range(1, len(read)))
    assert [tuple(r) for r in found.rows.collect()] == [(31234, 1, 1, "changed")]


def test_seeks_reach_both_scans(spark, folder, capsys):
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(f"{folder}/a")
    a = spark.read.parquet(f"{folder}/a")
    found = drill_down(a, a.selectExpr("k", "IF(k = 500, 0, v) AS v"), ["k"], leaf_rows=10, fanout=4)
    capsys.readouterr()
    found.rows.explain("formatted")
    pushed = [line for line in capsys.readouterr().out.split("\n") if line.startswith("PushedFilters")]
    assert len(pushed) == 2 and all("GreaterThan" in p and "LessThan" in p for p in pushed)


def test_odd_tables_are_compared(spark):
    a, b = pair(spark, 5, 60)
    empty = a.limit(0)
    assert drill_down(empty, empty, ["k"]).rows.isEmpty()
    assert drill_down(a, a, ["k"]).rows.isEmpty()
    assert {r.verdict for r in drill_down(empty, b, ["k", "s"], 5, 3).rows.collect()} == {"missing_in_a"}
    hot = spark.range(500).selectExpr("1 AS k", "id AS v")
    found = drill_down(hot, hot.where("v > 0"), ["k"], leaf_rows=10, fanout=4)
    assert [tuple(r) for r in found.rows.collect()] == [(1, 500, 499, "changed")]
    when = spark.createDataFrame([(dt.datetime(2020, 1, d), d) for d in range(1, 29)], "k timestamp_ntz, v int")
    assert drill_down(when, when.where("v <> 9"), ["k"], 3, 3).rows.first().k == dt.datetime(2020, 1, 9)
    with pytest.raises(ValueError, match="columns"):
        drill_down(a, a.drop("v"), ["k"])


# -- foreign keys in one scan ----------------------------------------------------------


def test_each_table_is_scanned_once(spark, folder, capsys):
    spark.range(50).selectExpr("id", "nullif(id % 9, 4) AS a", "CAST(id % 60 AS int) AS b").write.parquet(f"{folder}/c")
    spark.range(8).selectExpr("CAST(id AS int) AS id", "id AS other").write.parquet(f"{folder}/p")
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in "cp"}
    keys = [
        ForeignKey("a", "c", ("a",), "p", ("id",)), ForeignKey("b", "c", ("b",), "c", ("id",)),
        ForeignKey("ab", "c", ("a", "b"), "p", ("other", "id")), ForeignKey("back", "p", ("other",), "c", ("id",)),
    ]
    result = fk_integrity(tables, keys)
    rows = [(i, None if i % 9 == 4 else i % 9, i % 60) for i in range(50)]
    assert {tuple(r) for r in result.collect()} == {
        ("a", 50, sum(a is None for _, a, _ in rows), sum(a == 8 for _, a, _ in rows)),
        ("b", 50, 0, 0),
        ("ab", 50, sum(a is None for _, a, _ in rows), sum(a is not None and (a, b) not in {(i, i) for i in range(8)} for _, a, b in rows)),
        ("back", 8, 0, 0),
    }
    capsys.readouterr()
    result.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Location: InMemoryFileIndex") == 2


# -- sketches --------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(10,2)"])
def test_range_manifests_are_exact(spark, kind):
    df = spark.range(5000).selectExpr(f"CAST(nullif(id % 700, 3) AS {kind}) AS k")
    found = sketches.range_manifest(df, "k", 250)
    ranges = found.ranges.orderBy("chunk_id").collect()
    assert 15 <= len(ranges) <= 21 and sum(r.n_rows for r in ranges) == 5000 == ranges[-1].rows_done
    assert max(r.n_rows for r in ranges) < 3 * 250
    assert all(x.hi is None or y.lo is None or x.hi < y.lo for x, y in zip(ranges, ranges[1:]))
    for r in (ranges[3], ranges[-1]):
        assert df.where((F.col("k") >= r.lo) & (F.col("k") <= r.hi)).count() == r.n_rows


def test_manifests_take_appends_without_reading_old_rows(spark):
    old_rows, new_rows = spark.range(3000).selectExpr("id AS k"), spark.range(2000, 4000).selectExpr("id AS k")
    old = sketches.range_manifest(old_rows, "k", 300)
    both = sketches.extend_manifest(old, new_rows, "k")
    expected = sketches.range_manifest_at(old_rows.union(new_rows), "k", old.cuts)
    assert bag(both.ranges) == bag(expected.ranges)
    n = both.sketch.select(F.kll_sketch_get_n_bigint("sketch").alias("n")).first().n
    assert n == 5000
    full = sketches.overfull(both, 300).collect()
    assert len(full) == 1 and full[0].hi == 3999
    with pytest.raises(ValueError, match="numeric"):
        sketches.range_manifest(spark.sql("SELECT 'x' AS k"), "k", 5)


def test_odd_range_manifests(spark):
    empty = sketches.range_manifest(spark.range(0).selectExpr("id AS k"), "k", 5)
    assert empty.ranges.count() == 0
    grown = sketches.extend_manifest(empty, spark.range(7).selectExpr("id AS k"), "k")
    assert [(r.n_rows, r.lo, r.hi) for r in grown.ranges.collect()] == [(7, 0, 6)]
    nulls = sketches.range_manifest(spark.range(7).selectExpr("CAST(NULL AS int) AS k"), "k", 5)
    assert [(r.n_rows, r.lo) for r in nulls.ranges.collect()] == [(7, None)]
    nan = sketches.range_manifest(spark.range(9).selectExpr("IF(id = 3, double('NaN'), id) AS k"), "k", 3)
    assert sum(r.n_rows for r in nan.ranges.collect()) == 9


def test_statistics_read_new_files_only(spark, folder):
    path, store = f"{folder}/t", f"{folder}/stats"
    spark.range(1000).selectExpr("id", "nullif(id % 10, 3) AS v", "id % 3 = 0 AS n_rows").repartition(3).write.parquet(path)
    assert len(sketches.refresh_statistics(spark, path, store)) == 3
    assert sketches.refresh_statistics(spark, path, store) == []
    old = {p.name: p for p in Path(path).glob("part-*")}
    spark.range(1000, 1500).selectExpr("id", "id % 20 AS v", "true AS n_rows").coalesce(1).write.mode("append").parquet(path)
    # old files are not opened again: they may be unreadable by now
    for p in old.values():
        p.with_suffix(".away").write_bytes(p.read_bytes())
    new = sketches.refresh_statistics(spark, path, store)
    for p in old.values():
        p.with_suffix(".away").unlink()
    assert [n for n in new if n.endswith(".parquet")] and not set(new) & old.keys()
    found = {r["column"]: r for r in sketches.table_statistics(spark, path, store).collect()}
    assert (found["id"].n_rows, found["id"].n_nulls, found["id"].min_value, found["id"].max_value) == (1500, 0, "0", "1499")
    assert abs(found["id"].n_distinct - 1500) < 75 and found["v"].n_nulls == 100 and found["v"].n_distinct == 20
    assert found["n_rows"].n_distinct == 2


def test_files_that_are_gone_no_longer_count(spark, folder):
    path, store = f"{folder}/t", f"{folder}/stats"
    for i in range(2):
        spark.range(100 * i, 100 * i + 100).coalesce(1).write.mode("append").parquet(path)
    sketches.refresh_statistics(spark, path, store)
    low = next(r.f for r in spark.read.parquet(path).where("id = 5").select(F.col("_metadata.file_name").alias("f")).collect())
    Path(f"{path}/{low}").unlink()
    spark.catalog.refreshByPath(path)
    row = sketches.table_statistics(spark, path, store).first()
    assert (row.n_rows, row.min_value, row.n_distinct) == (100, "100", 100)
