from collections import Counter

import pytest

from coldshelf.operators import integrity, merge
from coldshelf.operators.compare import compare_chunks, compare_rows, fingerprint
from coldshelf.plans import staging


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_orphans_follow_not_exists(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9), (4, 1)], "id int, p int")
    parent = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    orphans, kept = merge.purge_orphans(child, parent, {"p": "k"})
    assert {r.id for r in orphans.collect()} == {2, 3}
    assert {r.id for r in kept.collect()} == {1, 4}


def test_delete_rows_matches_null_with_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (None, None, "c")], "x int, y int, z string")
    gone = spark.createDataFrame([(1, None), (1, None)], "x int, y int")
    assert {r.z for r in merge.delete_rows(df, gone, ["x", "y"]).collect()} == {"b", "c"}
    whole = df.where("z = 'c'")
    assert {r.z for r in merge.delete_rows(df, whole).collect()} == {"a", "b"}


@pytest.mark.parametrize("few", [0, 100_000])
def test_delete_exact_keeps_the_other_copies(spark, few, monkeypatch):
    monkeypatch.setattr(staging, "_FEW_ROWS", few)
    rows = [(None, 1)] * 5 + [(2, 1)] * 3 + [(3, 3)]
    df = spark.createDataFrame(rows, "a int, b int")
    gone = spark.createDataFrame([(None, 1)] * 2 + [(2, 1)] * 3 + [(9, 9)], "a int, b int")
    assert bag(merge.delete_rows_exact(df, gone)) == Counter({(None, 1): 3, (3, 3): 1})
    assert bag(merge.delete_rows_exact(df, gone)) == bag(df.exceptAll(gone))


@pytest.fixture
def dest(spark):
    return spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")


def test_broadcasts_need_few_rows_and_bytes(spark, monkeypatch):
    df = staging.stage(spark.range(10).selectExpr("id", "repeat('x', 100) AS t"))
    assert staging.is_few(df) and staging.is_few(df.limit(0))
    monkeypatch.setattr(staging, "_FEW_BYTES", 500)
    assert not staging.is_few(df)
    monkeypatch.setattr(staging, "_FEW_ROWS", 9)
    assert not staging.is_few(df)


def test_insert_ignore_keeps_old_and_first(spark, dest):
    incoming = spark.createDataFrame(
        [("c", 3), ("a", 3), ("new", 1), ("n1", None), ("n2", None)], "v string, k int"
    )
    found = bag(merge.insert_ignore(dest, incoming, ["k"], order_by=["v"]))
    assert found == bag(dest) + Counter({(3, "a"): 1, (None, "n1"): 1, (None, "n2"): 1})


def test_replace_takes_new_and_last(spark, dest):
    incoming = spark.createDataFrame([(3, "c"), (3, "a"), (1, "new"), (None, "n")], "k int, v string")
    found = bag(merge.replace_into(dest, incoming, ["k"], order_by=["v"]))
    assert found == Counter({(1, "new"): 1, (2, "old"): 1, (3, "c"): 1, (None, "old"): 1, (None, "n"): 1})


def test_several_unique_keys(spark):
    dest = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, u int, v string")
    incoming = spark.createDataFrame([(1, 30, "x"), (3, 20, "y"), (4, 40, "z")], "k int, u int, v string")
    assert {r.v for r in merge.insert_ignore(dest, incoming, [["k"], ["u"]]).collect()} == {"a", "b", "z"}
    assert {r.v for r in merge.replace_into(dest, incoming, [["k"], ["u"]]).collect()} == {"x", "y", "z"}
    clash = spark.createDataFrame([(5, 50, "x"), (6, 50, "y")], "k int, u int, v string")
    with pytest.raises(ValueError):
        merge.insert_ignore(dest, clash, [["k"], ["u"]])


def test_append_common_by_name(spark):
    dest = spark.createDataFrame([("n", 1)], "name string, id int")
    src = spark.createDataFrame([(2, "f", "m")], "id int, foo string, name string")
    assert merge.common_columns(dest, src.columns) == ["id", "name"]
    assert bag(merge.append_common(dest, src)) == Counter({("n", 1): 1, ("m", 2): 1})
    assert bag(merge.append_common(dest, src, ["id"])) == Counter({("n", 1): 1, (None, 2): 1})
    with pytest.raises(ValueError):
        merge.append_common(dest, src, [])


def test_fk_counts(spark):
    tables = {
        "child": spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 1)], "a int, b int"),
        "parent": spark.createDataFrame([(1, 1), (1, 1), (None, 1)], "x int, y int"),
    }
    fk = integrity.ForeignKey("f", "child", ("a", "b"), "parent", ("x", "y"))
    assert [tuple(r) for r in integrity.fk_integrity(tables, [fk]).collect()] == [("f", 4, 1, 1)]


def test_tables_present_with_and_without_case(spark):
    wanted = spark.createDataFrame([("D", "t"), ("d", "T")], "db string, tbl string")
    catalog = spark.createDataFrame([("D", "t")], "db string, tbl string")
    exact = integrity.tables_present(wanted, catalog)
    assert [r.present for r in exact.orderBy("db").collect()] == [True, False]
    folded = integrity.tables_present(wanted, catalog, lower_case_names=True)
    assert all(r.present for r in folded.collect())


def test_check_columns_of_two_frames(spark):
    a = spark.createDataFrame([], "id int, x string, y int, only_a int")
    b = spark.createDataFrame([], "id bigint, y int, x string")
    found = integrity.check_columns(integrity.schema_catalog(spark, a), integrity.schema_catalog(spark, b))
    assert {(r.name, r.difference) for r in found.collect()} == {
        ("id", "type"), ("x", "position"), ("y", "position"), ("only_a", "missing_in_b"),
    }


def test_compare_sees_swapped_nulls_and_copies(spark):
    schema = "k int, a int, b int"
    a = spark.createDataFrame([(1, None, 5), (2, 1, 1), (2, 1, 1), (3, 0, 0)], schema)
    b = spark.createDataFrame([(1, 5, None), (2, 1, 1), (4, 0, 0)], schema)
    found = {(r.k, r.verdict) for r in compare_rows(a, b, ["k"]).collect()}
    assert found == {(1, "changed"), (2, "changed"), (3, "missing_in_b"), (4, "missing_in_a")}
    assert compare_rows(a, a.repartition(3), ["k"]).isEmpty()


def test_chunk_comparison(spark):
    a = spark.range(100).selectExpr("id", "id * 2 AS v")
    b = a.where("id <> 37").withColumn("v", a.v + (a.id == 80).cast("int"))
    found = {r.chunk_id: r for r in compare_chunks(a, b, ["id"], 10).collect()}
    assert len(found) == 10
    assert {i for i, r in found.items() if r.verdict == "different"} == {3, 8}
    assert (found[3].rows_a, found[3].rows_b, found[3].differing_keys) == (10, 9, 1)


def test_fingerprint_adds_up(spark):
    df = spark.range(50).selectExpr("id", "nullif(id % 3, 1) AS v")
    whole, low, high = (fingerprint(x).first() for x in (df, df.where("id < 20"), df.where("id >= 20")))
    assert whole.checksum == low.checksum + high.checksum and whole.n_rows == 50
