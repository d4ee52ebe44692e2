import math

import numpy as np
import pytest

from coldshelf.llm.queries import QUERIES
from coldshelf.llm.spectrum import count_above, leading_eigenpairs
from coldshelf.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, n string, component string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def check(result, rows, k=4):
    """Hold the result against a plain calculation over all rows."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for _, v in usable]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array(sums) / n
    centred = np.array(fit) - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    found = {}
    for row in result.collect():
        found.setdefault((row.vec_id, row.component), []).append(row)
    assert sum(map(len, found.values())) == len(usable) * len(values)
    whole = np.array([[found[i, c + 1][0].whitened for c in range(len(values))] for i, _ in usable])
    want = (np.array(x) - mean) @ vectors / np.sqrt(values)
    assert np.abs(np.abs(whole) - np.abs(want)).max() < 1e-9
    sign = np.sign((whole * want).sum(axis=0))
    assert np.abs(whole * sign - want).max() < 1e-9
    for (i, _), entries in zip(usable, x):
        for c in range(len(values)):
            row = found[i, c + 1][0]
            assert row.n == n
            assert row.deviation == sum((n * e - s) ** 2 for e, s in zip(entries, sums))
            assert abs(row.explained / (values[c] / (centred**2).sum() * n) - 1) < 1e-9
            assert row.identity_error < 1e-9


def test_against_a_plain_calculation(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.standard_normal(9) * np.arange(1, 10) / 3 + 1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]  # copies count once
    rows += [(2000, None), (2001, [None] * 9), (2002, [float("nan")] * 9), (2003, [float("-inf")] * 9), (2004, [])]
    rows += [(2005, [1.0, 2.0])]  # of another length than most
    result = whiten(table(spark, rows).repartition(5))
    assert result.columns == COLUMNS
    check(result, [r for r in rows if r[0] != 2005])


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (5, [2.0, 2.0]), (5, [2.0, 2.0])]
    result = whiten(table(spark, rows)).collect()
    assert len(result) == 8 and sum(r.vec_id is None for r in result) == 4
    assert {r.n for r in result} == {3}


def test_without_variance(spark):
    assert whiten(table(spark, [])).columns == COLUMNS
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert whiten(table(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0
    one = whiten(table(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.component, abs(r.whitened)) for r in one) == [(1, 1, 1.0), (2, 1, 1.0)]


def test_large_entries(spark):
    rows = [(1, [3e10, 0.0]), (2, [-3e10, 0.0]), (3, [1e30, 1.0]), (4, [0.0, 0.25])]
    result = whiten(table(spark, rows)).collect()
    assert {r.vec_id for r in result} == {1, 2, 3, 4}
    assert all(r.deviation is None for r in result)


def test_exact_deviations_near_the_limit(spark):
    rows = [(i, [float(2**20 + i), 1.0, 0.0]) for i in range(3)]
    sums = [sum(256 * (2**20 + i) for i in range(3)), 768, 0]
    got = {r.vec_id: r.deviation for r in whiten(table(spark, rows)).collect()}
    assert got == {i: (3 * 256 * (2**20 + i) - sums[0]) ** 2 for i in range(3)}


def test_the_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op13_whitening"](spark, sf), rows)


def test_counts_by_inertia():
    r = np.random.default_rng(2)
    for d in (1, 2, 3, 8, 33):
        a = r.standard_normal((d, d))
        a = a + a.T
        for shift in (-3.0, -0.5, 0.0, 0.7, 4.0):
            assert count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize(
    "spectrum",
    [
        [9, 5, 3, 2, 1, 0.5], [5, 5, 5, 5, 5, 1], [5, 5, 3, 3, 3, 1], [4, 4 - 1e-13, 4 - 2e-13, 1, 1, 1],
        [4, 4 - 1e-9, 4 - 2e-9, 4 - 1e-7, 1, 1], [1e12, 3, 1, 1, 1, 1e-3], [7, 2, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0],
    ],
)
def test_leading_eigenpairs(spectrum):
    r = np.random.default_rng(5)
    q = np.linalg.qr(r.standard_normal((6, 6)))[0]
    v = q @ np.diag(spectrum).astype(float) @ q.T
    v = (v + v.T) / 2
    values, vectors = leading_eigenpairs(v, 4)
    size = max(spectrum)
    want = [s for s in spectrum[:4] if s > 24 * np.finfo(float).eps * size]
    assert len(values) == len(want)
    assert np.allclose(values, want, rtol=0, atol=1e-13 * size) and (np.diff(values) <= 0).all()
    assert np.allclose(vectors @ vectors.T, np.eye(len(want)), atol=1e-12)
    assert np.abs(v @ vectors.T - vectors.T * values).max(initial=0) <= 1e-13 * size
