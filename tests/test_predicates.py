import itertools
import random

import pytest
from pyspark.sql import functions as F

from coldshelf.operators import predicates as p

KEYS = ["d", "i", "c"]
CASES = [  # around the boundary (10, 5, 7)
    (10, 5, 6), (10, 5, 7), (10, 5, 8), (10, 5, None), (10, None, 7), (10, None, None),
    (10, 6, 1), (9, 9, 9), (11, 0, 0), (None, 5, 7), (None, None, None),
]


def rank(values):
    """Sort key for NULLS FIRST."""
    return [(v is not None, v or 0) for v in values]


OPS = {
    "<": lambda a, b: rank(a) < rank(b),
    "<=": lambda a, b: rank(a) <= rank(b),
    ">=": lambda a, b: rank(a) >= rank(b),
    ">": lambda a, b: rank(a) > rank(b),
}


@pytest.fixture(scope="module")
def rentals(spark):
    return spark.createDataFrame(CASES, "d int, i int, c int").cache()


@pytest.mark.parametrize("op", list(OPS))
@pytest.mark.parametrize("boundary", [(10, 5, 7), (10, None, 7), (10, 5, None), (None, None, None)])
def test_keyset_is_lexicographic_with_nulls_first(rentals, op, boundary):
    found = {tuple(r) for r in p.keyset_filter(rentals, KEYS, boundary, op).collect()}
    assert found == {c for c in CASES if OPS[op](c, boundary)}


@pytest.mark.parametrize("boundary", [(10, 5, 7), (10, None, 7)])
def test_keyset_agrees_with_struct_comparison(rentals, boundary):
    edge = F.struct(*[F.lit(v).cast("int").alias(k) for k, v in zip(KEYS, boundary)])
    twin = rentals.where(F.struct(*KEYS) > edge)
    found = p.keyset_filter(rentals, KEYS, boundary, ">")
    assert found.exceptAll(twin).isEmpty() and twin.exceptAll(found).isEmpty()


def test_four_operators_partition_rows(rentals):
    boundary = (10, 5, None)
    counts = {op: p.keyset_filter(rentals, KEYS, boundary, op).count() for op in OPS}
    assert counts["<"] + counts[">="] == len(CASES) == counts["<="] + counts[">"]


def test_first_n_keys_and_strict(rentals):
    first = p.keyset_filter(rentals, KEYS, (10, 5, 7), ">=", first_n_keys=1)
    assert {tuple(r) for r in first.collect()} == {c for c in CASES if (c[0] or 0) >= 10}
    whole = p.keyset_filter(rentals, KEYS, (10, 5, 7), ">=", first_n_keys=9)
    assert whole.count() == p.keyset_filter(rentals, KEYS, (10, 5, 7), ">=").count()
    strict = p.keyset_filter(rentals, KEYS, (10, 5, 7), ">=", strict=True)
    assert strict.count() == whole.count() - 1


def test_key_order_may_differ_from_column_order(rentals):
    reordered = ["d", "c", "i"]
    found = {tuple(r) for r in p.keyset_filter(rentals, reordered, (10, 7, 5), ">").collect()}
    order = lambda c: (c[0], c[2], c[1])
    assert found == {c for c in CASES if OPS[">"](order(c), (10, 7, 5))}


def test_enum_keys_compare_by_member_position(spark):
    ratings = ["G", "PG", "PG-13", "R", "NC-17"]
    df = spark.createDataFrame([(r,) for r in [*ratings, None]], "rating string")
    after = p.keyset_filter(df, ["rating"], ("PG-13",), ">", enums={"rating": ratings})
    assert {r[0] for r in after.collect()} == {"R", "NC-17"}
    before = p.keyset_filter(df, ["rating"], ("PG",), "<=", enums={"rating": ratings})
    assert {r[0] for r in before.collect()} == {None, "G", "PG"}


def test_keyset_errors(rentals):
    with pytest.raises(ValueError):
        p.keyset_predicate(KEYS, (1, 2, 3), "=")
    with pytest.raises(ValueError):
        p.keyset_predicate([], ())
    with pytest.raises(ValueError):
        p.keyset_predicate(KEYS, (1, 2))


def test_split_keeps_every_row_once(rentals):
    archived, kept = p.archive_split(rentals, "c > 6")
    assert archived.count() == 5
    both = archived.unionByName(kept)
    assert both.exceptAll(rentals).isEmpty() and rentals.exceptAll(both).isEmpty()
    assert kept.where("c IS NULL").count() == 3


def test_changing_predicate_is_evaluated_once(spark):
    rows = spark.range(5000)
    archived, kept = p.archive_split(rows, "rand() < 0.5", deterministic=False)
    assert archived.intersect(kept).isEmpty()
    assert archived.count() + kept.count() == 5000


def test_purge_and_copy(rentals):
    assert p.purge(rentals, "c > 6").count() == len(CASES) - 5
    assert p.copy_only(rentals, "c > 6").count() == 5


def test_select_completes_columns_with_keys(rentals):
    df = p.archive_select(rentals, "true", ["c"], keys=["d", "c"], with_keys=True)
    assert df.columns == ["c", "d"]
    assert p.archive_select(rentals, "true", ["c"], keys=["d"]).columns == ["c"]
    assert p.archive_select(rentals, "true", primary_key_only=True, keys=["i", "d"]).columns == ["i", "d"]
    with pytest.raises(ValueError):
        p.archive_select(rentals, "  ")
    with pytest.raises(ValueError):
        p.archive_select(rentals, "true", primary_key_only=True)


def test_literal_text_matches_itself_only(spark):
    alphabet = ["a", "b", "%", "_", "\\"]
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product(alphabet, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").cache()
    for wanted in random.Random(3).sample(texts, 12):
        for how, test in [
            ("equals", lambda t: t == wanted),
            ("prefix", lambda t: t.startswith(wanted)),
            ("suffix", lambda t: t.endswith(wanted)),
            ("contains", lambda t: wanted in t),
        ]:
            expected = {t for t in texts if test(t)}
            found = {r[0] for r in p.filter_literal(df, "t", wanted, how).collect()}
            assert found == expected
            pattern = {"equals": "{}", "prefix": "{}%", "suffix": "%{}", "contains": "%{}%"}[how]
            like = F.like("t", F.lit(pattern.format(p.escape_like(wanted, "!"))), F.lit("!"))
            assert {r[0] for r in df.where(like).collect()} == expected


def test_literal_prefix_reaches_the_scan(spark, folder, capsys):
    spark.createDataFrame([("a_b",), ("axb",)], "t string").write.parquet(f"{folder}/t")
    p.filter_literal(spark.read.parquet(f"{folder}/t"), "t", "a_", "prefix").explain("formatted")
    assert "StringStartsWith(t,a_)" in capsys.readouterr().out


def test_split_finds_out_whether_a_predicate_is_stable(spark):
    from coldshelf.operators.predicates import archive_split, is_stable

    frame = spark.range(10_000)
    frame.createOrReplaceTempView("stable_ids")
    assert is_stable(frame, "id % 3 = 1") and is_stable(frame, F.col("id") > 5)
    for where in ("rand() < 0.5", "current_timestamp() > TIMESTAMP '2020-01-01'", "id IN (SELECT id FROM stable_ids)"):
        assert not is_stable(frame, where)
    archived, kept = archive_split(frame, "rand() < 0.5")
    ids = sorted(r.id for side in (archived, kept) for r in side.collect())
    assert ids == list(range(10_000))
