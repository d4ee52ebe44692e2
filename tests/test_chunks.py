import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from coldshelf.operators import chunks as c


def key(values):
    return [(v is not None, v if v is not None else 0) for v in values]


@pytest.fixture(scope="module")
def rows(spark):
    """Repeated and missing keys, equal rows, and one key with a third of all rows."""
    rng = random.Random(5)
    data = [
        (7 if rng.random() < 0.33 else rng.choice([None, *range(30)]), rng.randrange(4), rng.choice("xy"))
        for _ in range(1200)
    ]
    return data


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v int, w string").repartition(5).cache()


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_assign_chunks_numbers_like_a_global_sort(frame, rows, partitions):
    found = c.assign_chunks(frame, ["k"], 100, partitions=partitions).collect()
    assert Counter((r.k, r.v, r.w) for r in found) == Counter(rows)
    in_order = sorted(found, key=lambda r: r.row_no)
    assert [r.row_no for r in in_order] == list(range(1, len(rows) + 1))
    ordered = [(key((r.k, r.v)), r.w) for r in in_order]
    assert ordered == sorted(ordered)
    assert all(r.chunk_id == (r.row_no - 1) // 100 for r in found)


@pytest.mark.parametrize("partitions", [None, 6])
def test_assign_chunks_on_unique_keys(spark, partitions):
    ids = random.Random(1).sample(range(10_000), 1000)
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(4)
    found = {r.id: r.row_no for r in c.assign_chunks(df, ["id"], 64, unique=True, partitions=partitions).collect()}
    assert found == {i: n for n, i in enumerate(sorted(ids), 1)}


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
@pytest.mark.parametrize("partitions", [None, 5])
def test_manifest_with_hot_key(frame, rows, size, partitions):
    ordered = sorted((r[0] for r in rows), key=lambda k: key([k]))
    found = c.chunk_manifest(frame, ["k"], size, partitions=partitions).collect()
    expected = [
        (i, len(part), i * size + len(part), part[0], part[-1])
        for i, part in enumerate(ordered[n : n + size] for n in range(0, len(ordered), size))
    ]
    got = sorted((r.chunk_id, r.n_rows, r.rows_done, r.lo.k, r.hi.k) for r in found)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    by_id = {r.chunk_id: (r.lo.k, r.hi.k) for r in found}
    assert all(by_id[e[0]] == e[3:] for e in expected)


def test_weights_are_summed_over_many_runs(frame, rows, monkeypatch):
    monkeypatch.setattr(c, "_RUN_BITS", 2)
    found = c.assign_chunks(frame, ["k"], 100, partitions=3).collect()
    assert [r.row_no for r in sorted(found, key=lambda r: (key((r.k, r.v)), r.w, r.row_no))] == list(
        range(1, len(rows) + 1)
    )
    manifest = c.chunk_manifest(frame, ["k", "v"], 9, partitions=3).collect()
    assert sum(m.n_rows for m in manifest) == len(rows)


def test_distinct_rows_need_no_weights(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    ordered = c.stage_in_order(df.groupBy("k", "v").agg(F.count("*").alias("n")), ["k", "v"], "n")
    assert ordered.single and ordered.total == 100
    doubled = df.union(df).groupBy("k", "v").agg(F.count("*").alias("n"))
    assert c.stage_in_order(doubled, ["k", "v"], "n")[1:] == (200, False)


def test_empty_table(spark):
    none = spark.createDataFrame([], "k int, v int")
    assert c.chunk_manifest(none, ["k"], 10).isEmpty()
    assert c.assign_chunks(none, ["k"], 10).isEmpty()
    assert c.assign_chunks(none, ["k"], 10, unique=True).isEmpty()


def test_many_copies_are_spread_in_blocks(spark):
    df = spark.createDataFrame([("a", 0, 24), ("b", 25, 25), ("c", 26, 99)], "n string, f bigint, l bigint")
    out = c.multiply(df, F.col("f"), F.col("l"), "i", block=10)
    assert sorted(r.i for r in out.collect()) == list(range(100))
    assert {r.n for r in out.where("i = 25").collect()} == {"b"}


def test_chunk_size_must_be_positive(frame):
    for call in (c.assign_chunks, c.chunk_manifest):
        with pytest.raises(ValueError):
            call(frame, ["k"], 0)


def test_pages_put_together_are_the_sorted_table(frame, rows):
    order = c.page_order(frame, ["k"])
    seen, after, skip = [], None, 0
    while True:
        page = c.next_page(frame, ["k"], after, 170, skip=skip).collect()
        if not page:
            break
        seen += [tuple(r) for r in page]
        after = page[-1].asDict()
        skip = sum(1 for s in seen if s == tuple(page[-1]))
    assert seen == sorted(rows, key=lambda r: (key(r[:2]), r[2]))
    assert order == ["k", "v", "w"]


def test_no_window_over_the_whole_table(spark, frame, capsys):
    c.assign_chunks(frame, ["k"], 10).explain("formatted")
    c.chunk_manifest(frame, ["k"], 10).explain("formatted")
    c.assign_chunks(spark.range(9), ["id"], 10, unique=True).explain("formatted")
    assert "SinglePartition" not in capsys.readouterr().out


def test_page_is_a_top_k_with_pushed_filter(spark, folder, capsys):
    spark.range(100).selectExpr("id AS a", "id % 7 AS b").write.parquet(f"{folder}/t")
    table = spark.read.parquet(f"{folder}/t")
    c.next_page(table, ["b", "a"], (3, 50), 5, unique=True).explain("formatted")
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [Or(" in plan
