import random

import numpy as np
import xxhash

from coldshelf.llm import simhash
from coldshelf.llm.components import connected_components
from llm.cases import ODD, docs


def brute_print(text, shingle=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    """Least key reachable over links of four bits, for {key: print}."""
    out = {}
    for start in sorted(prints):
        if start in out:
            continue
        todo, out[start] = [start], start
        while todo:
            here = todo.pop()
            for other in prints:
                if other not in out and (prints[here] ^ prints[other]).bit_count() <= 4:
                    out[other] = start
                    todo.append(other)
    return out


def sample(n, seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(r.choice(words) for _ in range(r.randrange(0, 90))) for _ in range(n)]
    for i in range(n // 3):
        parts = texts[i].split()
        if len(parts) > 30:
            parts[r.randrange(len(parts))] = "edited"
        texts.append(" ".join(parts))
    return list(enumerate(texts)) + [(9000 + i, " ".join(["A"] * i)) for i in range(6)]


def test_groups(spark):
    rows = sample(150) + [(i, t) for i, t in ODD if i not in (1, 2, 3, 4, 5, 6)]
    rows += [(10_000 + (i or 0), t) for i, t in ODD if i is not None]
    found = simhash.near_duplicates(docs(spark, rows, extra=True)).collect()
    assert len(found) == len(rows)
    by_id = dict(rows)
    named = {i: brute_print(t) for i, t in rows if i is not None}
    groups = brute_groups(named)
    for row in found:
        if row.doc_id is None:
            assert row.fingerprint == f"{brute_print('no id'):016x}"
            continue
        assert row.fingerprint == f"{named[row.doc_id]:016x}", by_id[row.doc_id]
        assert row.component_id == groups[row.doc_id]
    assert len(set(groups.values())) < len(groups)


def test_crowded_shards_and_slices(spark):
    r = np.random.default_rng(4)
    base = r.integers(0, 2**63, 400)
    near = [int(base[7]) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in r.integers(0, 60, (300, 2))]
    chain = [int(base[9]) ^ ((1 << (4 * i)) - 1) for i in range(15)]  # linked one after another only
    values = sorted({*map(int, base), *near, *chain})
    expected = brute_groups({v: v for v in values})
    prints = spark.createDataFrame([(v,) for v in values], "print bigint")
    for slices in (1, 2, 4):
        for shard_rows in (16_384, 8):
            links = simhash.near_links(prints, 4, slices, shard_rows)
            groups = {row.node: row.component for row in connected_components(links).collect()}
            for v in values:
                assert groups.get(v, v) == expected[v], (slices, shard_rows)


def test_hot_group_gives_a_forest(spark):
    rows = [(i, "same text of many copies here") for i in range(2000)] + [(5000, "something else is in this one")]
    found = simhash.near_duplicates(docs(spark, rows)).collect()
    assert {r.component_id for r in found} == {0, 5000}
    r = np.random.default_rng(1)
    base = np.uint64(12345)
    close = np.unique(np.array([base ^ np.uint64(1 << int(a)) for a in r.integers(0, 64, 900)], dtype=np.uint64))
    links = simhash.link_shard(close, np.ones(len(close), dtype=bool), 0xFFFF, 4, 1)
    assert len(links) == len(close) - 1


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []


def test_components(spark):
    pairs = [(9, 1), (2, 9), (5, 5), (7, 8), (100, 99)] + [(i, i + 1) for i in range(200, 260)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert found == {1: 1, 2: 1, 9: 1, 7: 7, 8: 7, 99: 99, 100: 99} | {i: 200 for i in range(200, 261)}
