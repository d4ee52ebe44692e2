"""Plans that should stay as they are."""

import pytest

from coldshelf.operators import chunks, merge, predicates, stats
from coldshelf.operators.compare import compare_rows
from coldshelf.plans import staging
from suite import rows


@pytest.fixture
def plan_of(capsys):
    def explain(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return explain


@pytest.fixture
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.01/orders.parquet")


def scan_columns(plan):
    return [line for line in plan.split("\n") if line.startswith("ReadSchema")]


def test_selection_is_pruned_and_pushed(spark, plan_of):
    plan = plan_of(rows.archive_select(spark, "/root/testdata/sf0.01"))
    assert "LessThan(o_orderdate" in plan
    assert "o_custkey" not in scan_columns(plan)[0]


def test_seek_is_pushed(orders, plan_of):
    seek = predicates.keyset_filter(orders, ["o_orderkey", "o_custkey"], (100, None), ">")
    plan = plan_of(seek.select("o_orderkey"))
    assert "PushedFilters: [Or(GreaterThan(o_orderkey,100),And(EqualNullSafe(o_orderkey,100)" in plan


def test_seek_by_enum_members_is_pushed(orders, plan_of):
    members = {"o_orderstatus": ["O", "P", "F"]}
    after = predicates.keyset_filter(orders, ["o_orderstatus", "o_orderkey"], ("P", 1000), ">=", enums=members)
    plan = plan_of(after.select("o_orderkey"))
    pushed = next(line for line in plan.split("\n") if line.startswith("PushedFilters"))
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThan(o_orderkey,1000)" in pushed
    plan = plan_of(predicates.keyset_filter(orders, ["o_orderstatus"], ("O",), ">", enums=members).select("o_orderkey"))
    assert "In(o_orderstatus, [F,P])" in plan


def test_autoinc_guard_is_a_scalar_not_a_join(orders, plan_of):
    plan = plan_of(stats.keep_latest_autoinc(orders, "o_orderkey", orders))
    assert "Subquery" in plan and "Join" not in plan


def test_null_safe_delete_is_a_hash_or_merge_join(orders, plan_of):
    plan = plan_of(merge.delete_rows(orders, orders.where("o_orderkey < 5"), ["o_orderkey"]))
    assert "LeftAnti" in plan and "NestedLoop" not in plan


def test_deleting_few_rows_shuffles_none_of_the_others(orders, plan_of):
    plan = plan_of(merge.delete_rows_exact(orders, orders.limit(5)))
    assert "BroadcastHashJoin LeftAnti" in plan and "BroadcastHashJoin LeftSemi" in plan


def test_exact_deletion_and_comparison_combine_before_the_shuffle(orders, plan_of, monkeypatch):
    monkeypatch.setattr(staging, "_FEW_ROWS", 0)
    for df in (
        merge.delete_rows_exact(orders, orders.limit(5)),
        compare_rows(orders, orders.where("o_orderkey > 5"), ["o_orderkey"]),
    ):
        plan = plan_of(df)
        assert plan.index("HashAggregate") < plan.index("Exchange")
        assert "partial_sum" in plan and "SortAggregate" not in plan


def test_column_statistics_hash_their_values(orders, plan_of):
    plan = plan_of(stats.analyze_columns(orders.select("o_orderstatus")))
    assert "Expand" not in plan and "partial_count" in plan


def test_counter_deltas_without_hot_devices_need_one_shuffle(spark, plan_of):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    deltas = stats.counter_deltas(events.select("user_id", "ts", "value"), ["user_id"], "ts", ["value"])
    plan = plan_of(deltas)
    assert "Join" not in plan and plan.count(") Exchange") == 1


def test_first_page_does_not_sort_the_table(orders, plan_of):
    assert "TakeOrderedAndProject" in plan_of(chunks.next_page(orders, ["o_orderkey"], n=10, unique=True))
