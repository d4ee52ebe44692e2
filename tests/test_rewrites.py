"""Deleting from files, joining small ones, and swaps that break off."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from coldshelf.operators import swap as swap_module
from coldshelf.operators.compact import compact_small, pack
from coldshelf.operators.file_deletes import delete_copies_in_files, delete_rows_in_files, within
from coldshelf.operators.merge import delete_rows, delete_rows_exact
from coldshelf.operators.sketches import refresh_statistics
from coldshelf.operators.swap import finish_swap, flat_files
from suite import files as file_queries
from suite.files import suite as file_suite


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def stamps(path):
    return {p.name: p.stat().st_mtime_ns for p in Path(path).glob("*.parquet")}


@pytest.fixture
def path(spark, folder):
    rows = spark.range(1000).selectExpr("id", "nullif(id % 7, 3) AS v", "CAST(id % 5 AS string) AS s")
    path = f"{folder}/t"
    rows.repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(path)
    return path


def test_only_files_with_named_rows_are_rewritten(spark, path):
    before, table = stamps(path), spark.read.parquet(path)
    named = table.where("id BETWEEN 300 AND 340 AND id % 2 = 0")
    expected = bag(delete_rows(table, named, ["id"]))
    result = delete_rows_in_files(spark, path, named, ["id"])
    after = stamps(path)
    assert 1 <= len(result.replaced) <= 2 and set(result.replaced) == before.keys() - after.keys()
    assert all(after[n] == before[n] for n in before.keys() - set(result.replaced))
    assert result.rows_before - result.rows_after == 21
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == expected
    assert not Path(f"{path}/_shelf").exists()


def test_the_search_is_pruned_by_the_keys_named(spark, path, capsys):
    table = spark.read.parquet(path)
    named = spark.createDataFrame([(300, "a"), (340, "b")], "id bigint, s string")
    capsys.readouterr()
    within(table, named, ["id", "s"]).select("id").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(id,300)" in plan and "LessThanOrEqual(id,340)" in plan and "LessThanOrEqual(s,b)" in plan
    assert "ReadSchema: struct<id:bigint,s:string>" in plan


def test_files_without_named_keys_are_not_opened(spark, path):
    """With stored statistics, files outside the range may even be broken."""
    store = f"{path}-stats"
    refresh_statistics(spark, path, store)
    table = spark.read.parquet(path)
    files = table.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("id").alias("lo"), F.max("id").alias("hi")).collect()
    files = sorted(files, key=lambda r: r.lo)
    target = files[-1]
    named = spark.createDataFrame([(target.lo + 1,), (target.hi,)], "id bigint")
    broken = Path(path) / files[3].f
    whole = broken.read_bytes()
    broken.write_bytes(b"not a table any more")
    spark.catalog.refreshByPath(path)
    result = delete_rows_in_files(spark, path, named, ["id"], store=store)
    assert result.replaced == (target.f,) and result.rows_before - result.rows_after == 2
    nothing = delete_rows_in_files(spark, path, spark.createDataFrame([(-7,)], "id bigint"), ["id"], store=store)
    assert nothing.replaced == ()
    broken.write_bytes(whole)
    spark.catalog.refreshByPath(path)
    left = {r.id for r in spark.read.parquet(path).collect()}
    assert left == set(range(1000)) - {target.lo + 1, target.hi}


def test_stored_statistics_allow_for_null_keys(spark, path):
    store = f"{path}-stats"
    table = spark.read.parquet(path)
    named = spark.createDataFrame([(None, "1"), (5, "2")], "v bigint, s string")
    expected = bag(delete_rows(table, named, ["v", "s"]))
    delete_rows_in_files(spark, path, named, ["v", "s"], store=store)
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == expected
    copies = spark.createDataFrame([(1, 1, "1"), (2, 2, "2"), (2, 2, "2"), (10**6, 1, "1")], "id bigint, v bigint, s string")
    expected = bag(delete_rows_exact(spark.read.parquet(path), copies))
    delete_copies_in_files(spark, path, copies, store=store)
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == expected


def test_null_keys_match_null_and_empty_sets_change_nothing(spark, path):
    table = spark.read.parquet(path)
    before = stamps(path)
    assert delete_rows_in_files(spark, path, table.limit(0), ["id"]).replaced == ()
    assert delete_rows_in_files(spark, path, spark.createDataFrame([(-5,)], "id bigint"), ["id"]).replaced == ()
    assert stamps(path) == before
    named = spark.createDataFrame([(None, "1"), (2, "4")], "v bigint, s string")
    expected = bag(delete_rows(table, named, ["v", "s"]))
    delete_rows_in_files(spark, path, named, ["v", "s"])
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == expected


def test_all_rows_may_go(spark, path):
    delete_rows_in_files(spark, path, spark.read.parquet(path), ["id"])
    spark.catalog.refreshByPath(path)
    left = spark.read.parquet(path)
    assert left.count() == 0 and left.columns == ["id", "v", "s"]


@pytest.mark.parametrize("seed", range(3))
def test_copies_agree_with_the_whole_table_way(spark, folder, seed):
    r = random.Random(seed)
    rows = [(r.randrange(6), r.choice([None, "a", "b"])) for _ in range(400)] + [(99, "hot")] * 300
    path = f"{folder}/c"
    spark.createDataFrame(rows, "k int, s string").repartition(6).write.parquet(path)
    table = spark.read.parquet(path)
    gone = [x for x in set(rows) for _ in range(r.randrange(0, 30))] + [(99, "hot")] * 40 + [(1234, "absent")]
    archived = spark.createDataFrame(gone, "k int, s string")
    expected = bag(delete_rows_exact(table, archived))
    result = delete_copies_in_files(spark, path, archived)
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == expected
    assert result.rows_before - result.rows_after == len(rows) - sum(expected.values())


def test_copies_touch_no_more_files_than_needed(spark, folder):
    path = f"{folder}/c"
    for n in (50, 5, 5):
        spark.range(n).selectExpr("1 AS k").coalesce(1).write.mode("append").parquet(path)
    result = delete_copies_in_files(spark, path, spark.range(7).selectExpr("1 AS k"))
    assert len(result.replaced) == 1 and result.rows_before == 50


@pytest.mark.parametrize("after", [0, 1, 2])
def test_a_swap_that_broke_off_is_finished(spark, path, monkeypatch, after):
    table = spark.read.parquet(path)
    expected = bag(table.where("id % 10 <> 0"))
    named = spark.createDataFrame([(i,) for i in range(0, 1000, 10)], "id bigint")
    move, calls = swap_module.move_files, []

    def broken(spark, folder, into, prefix, only=None):
        calls.append(1)
        if len(calls) > after // 2:
            if after % 2:  # one file has moved
                files = sorted(Path(folder).glob("part-*"))
                Path(into).mkdir(exist_ok=True, parents=True)
                files[0].rename(f"{into}/{prefix}{files[0].name}")
            raise OSError("the driver is lost")
        move(spark, folder, into, prefix, only)

    monkeypatch.setattr(swap_module, "move_files", broken)
    with pytest.raises(OSError):
        delete_rows_in_files(spark, path, named, ["id"])
    monkeypatch.undo()
    assert finish_swap(spark, path) is not None
    assert finish_swap(spark, path) is None
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == expected


def test_folders_below_a_table_are_refused(spark, folder):
    spark.range(10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(f"{folder}/p")
    with pytest.raises(ValueError, match="folders"):
        flat_files(spark, f"{folder}/p")


# -- joining small files ---------------------------------------------------------------


def test_packing():
    r = random.Random(1)
    for _ in range(200):
        sizes = {f"f{i}": r.randrange(1, 60) for i in range(r.randrange(20))}
        bins = pack(sizes, 40)
        names = [n for b in bins for n in b]
        assert len(names) == len(set(names)) and all(len(b) > 1 and sum(sizes[n] for n in b) <= 40 for b in bins)
        alone = sorted(sizes[n] for n in sizes.keys() - set(names) if sizes[n] <= 40)
        assert all(a + b > 40 for a, b in zip(alone, alone[1:]))  # no two left over would fit together
    assert pack({"a": 41, "b": 1}, 40) == []


def test_only_small_files_are_joined(spark, folder):
    path = f"{folder}/t"
    spark.range(200_000).selectExpr("id", "uuid() AS u").coalesce(1).write.parquet(path)
    spark.range(1000, 3000).selectExpr("id", "uuid() AS u").repartition(12).write.mode("append").parquet(path)
    before, content = stamps(path), bag(spark.read.parquet(path))
    sizes = flat_files(spark, path)
    large = [n for n, size in sizes.items() if size > 1 << 20]
    result = compact_small(spark, path, small_bytes=1 << 20, target_bytes=4 << 20, keys=["id"])
    after = stamps(path)
    assert len(large) == 1 and after[large[0]] == before[large[0]]
    assert len(after) == 2 and set(result.replaced) == before.keys() - set(large)
    spark.catalog.refreshByPath(path)
    assert bag(spark.read.parquet(path)) == content
    joined = next(n for n in after if n != large[0])
    ids = [r.id for r in spark.read.parquet(f"{path}/{joined}").collect()]
    assert ids == sorted(ids) and len(ids) == 2000
    assert compact_small(spark, path, small_bytes=1 << 20, target_bytes=4 << 20).replaced == ()
    with pytest.raises(ValueError, match="small"):
        compact_small(spark, path, small_bytes=9, target_bytes=8)


def test_each_bin_becomes_one_file(spark, folder):
    path = f"{folder}/t"
    spark.range(9000).selectExpr("id", "uuid() AS u").repartition(30).write.parquet(path)
    size = max(flat_files(spark, path).values())
    compact_small(spark, path, small_bytes=2 * size, target_bytes=5 * size)
    found = flat_files(spark, path)
    assert 6 <= len(found) <= 8 and max(found.values()) <= 6 * size
    assert spark.read.parquet(path).count() == 9000


def test_compaction_query_keeps_files_small_and_tasks_many(spark, folder):
    lines = spark.range(1_200_000).selectExpr("id AS l_orderkey", "CAST(id % 3 + 1 AS int) AS l_linenumber", "hash(id) + 0L AS l_partkey")
    lines.repartition(4).write.parquet(f"{folder}/lineitem.parquet")
    result = file_suite.queries["compacted_small"](spark, folder)
    files = result.groupBy("_metadata.file_path").agg(
        F.count("*").alias("n"), F.max("l_linenumber").alias("kind"), F.max("_metadata.file_size").alias("size")
    ).collect()
    assert sum(f.n for f in files) == 1_200_000
    assert max(f.n for f in files if f.kind < 3) < 400_000  # not one task for all
    assert max(f.size for f in files if f.kind == 3) <= 320 << 10 and 20 < len(files) < 80  # small ones were joined


def test_keyed_batches_are_written_by_many_tasks(spark, folder, monkeypatch):
    rows = spark.range(400).selectExpr(
        "id % 50 AS o_custkey", "id AS o_orderkey", "'O' AS o_orderstatus", "TIMESTAMP_NTZ '1995-05-05 00:00:00' AS o_orderdate"
    )
    rows.repartition(4).write.parquet(f"{folder}/orders.parquet")
    start, seen = file_queries.start_keyed_stream, []

    def noted(spark, in_path, *args, **options):
        seen.append(len(spark.read.parquet(in_path).inputFiles()))
        return start(spark, in_path, *args, **options)

    monkeypatch.setattr(file_queries, "start_keyed_stream", noted)
    found = file_suite.queries["stream_keyed"](spark, folder).collect()
    assert sorted((r.o_custkey, r.o_orderkey) for r in found) == [(i, i) for i in range(50)]
    assert len(seen) == 1 and 1 < seen[0] <= 64  # one batch, of several files
