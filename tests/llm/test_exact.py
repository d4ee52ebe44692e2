import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from coldshelf.llm import exact, quotient
from coldshelf.llm.exact import exact_duplicates, repeated_prints
from coldshelf.llm.queries import QUERIES, SQL
from harness import connect, spark_rows, sql_rows
from llm.cases import LONG, ODD, docs

SF = "/root/testdata/sf0.01"


def expected(rows):
    """Per row what must come out, ties resolved to the first row."""
    groups = defaultdict(list)
    for place, (doc_id, text, *_) in enumerate(rows):
        groups[text or ""].append((doc_id is not None, doc_id or 0, -place))
    out = []
    for place, (doc_id, text, *_) in enumerate(rows):
        group = groups[text or ""]
        has_id, best, first = max(group)
        kept = -first == place
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, best if has_id else None, len(group), kept, sha))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_odd_rows(spark):
    rows = [*ODD, (7, ""), (8, LONG), (9, LONG + "x"), (None, "no id"), (None, None), (9, "one")]
    assert found(exact_duplicates(docs(spark, rows, extra=True))) == expected(rows)


def test_random_copies_with_repeated_ids(spark):
    r = random.Random(3)
    rows = [(r.randrange(60), r.choice("abcdefgh") * r.randrange(1, 30)) for _ in range(900)]
    rows += [(10_000 + i, "hot text") for i in range(600)]
    assert found(exact_duplicates(docs(spark, rows).repartition(5))) == expected(rows)


def test_many_groups_meet_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr("coldshelf.llm.hot.HOT_GROUPS", 3)
    rows = [(i, f"text {i % 400}") for i in range(1000)] + [(2000 + i, "hot") for i in range(600)]
    assert found(exact_duplicates(docs(spark, rows))) == expected(rows)


def test_texts_with_one_fingerprint_are_told_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact.F, "xxhash64", lambda text: F.length(text).cast("bigint"))
    rows = [(i, "abcd"[i % 4] * (i % 5)) for i in range(100)]
    assert found(exact_duplicates(docs(spark, rows))) == expected(rows)


def test_empty_table(spark):
    result = exact_duplicates(docs(spark, []))
    assert result.count() == 0 and result.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("bits", [12, 40, 64])
def test_a_filter_gives_back_what_it_counted(bits):
    r = np.random.default_rng(bits)
    for n in (0, 1, 2, 50, 3000):
        prints = np.unique(r.integers(0, 1 << min(bits, 62), n, dtype=np.uint64))
        counts = np.where(r.random(len(prints)) < 0.5, 1, r.integers(1, 1 << 40, len(prints)))
        back, numbers = quotient.decode(quotient.encode(prints, counts, bits))
        assert (back == prints).all() and (numbers == counts).all()


def test_crowded_neighbours_and_the_last_slots():
    prints = np.array([0, 1, 2, 3, 2**64 - 3, 2**64 - 2, 2**64 - 1], dtype=np.uint64)
    counts = np.array([1, 9, 1, 2**50, 3, 1, 7])
    back, numbers = quotient.decode(quotient.encode(prints, counts, 64))
    assert (back == prints).all() and (numbers == counts).all()


def test_merging_loses_nothing():
    r = np.random.default_rng(1)
    parts = [r.integers(0, 500, n, dtype=np.uint64) for n in (700, 1, 300, 0)]
    filters = [quotient.encode(*np.unique(p, return_counts=True), 40) for p in parts]
    prints, counts = quotient.merge(filters)
    want, numbers = np.unique(np.concatenate(parts), return_counts=True)
    assert (prints == want).all() and (counts == numbers).all()


def test_ranges_of_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(exact, "SHARD_ROWS", 50)
    monkeypatch.setattr(exact, "FILTER_ROWS", 40)
    r = random.Random(2)
    values = [r.randrange(-(1 << 63), 1 << 63) for _ in range(400)]
    rows = [(v,) for i, v in enumerate(values) for _ in range(1 + i % 3)]
    df = spark.createDataFrame(rows, "print bigint").repartition(4)
    assert {tuple(x) for x in repeated_prints(df, df.count()).collect()} == {
        (v, 1 + i % 3) for i, v in enumerate(values) if i % 3
    }


def test_query_agrees_with_sql(spark):
    result, columns = spark_rows(QUERIES["op12_exact_dedup"](spark, SF))
    assert (result, columns) == sql_rows(connect(SF), SQL["op12_exact_dedup"])
