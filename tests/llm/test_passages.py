import random
import time

import numpy as np
import pytest

from coldshelf.llm import bitfilter
from coldshelf.llm import passages as p
from llm.cases import ODD, docs

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so", "ta", "vi") for b in ("den", "fal", "gor", "hum", "jin", "")]


def prose(r, n):
    return [r.choice(WORDS) for _ in range(n)]


def slow_chain(xs, ys, weight, gap):
    """Best chain score by comparing all pairs of matches."""
    order = sorted(range(len(xs)), key=lambda i: (xs[i], ys[i]))
    score = {}
    for i in order:
        earlier = [score[j] - gap * (xs[i] - xs[j] + ys[i] - ys[j]) for j in score if xs[j] < xs[i] and ys[j] < ys[i]]
        score[i] = weight + max(0.0, *earlier, 0.0)
    return max(score.values())


def test_chains_against_all_pairs():
    r = random.Random(1)
    for _ in range(200):
        n = r.randrange(1, 40)
        xs, ys = [r.randrange(60) for _ in range(n)], [r.randrange(60) for _ in range(n)]
        chains = p.chain(xs, ys, 6)
        assert sorted(i for c in chains for i in c) == list(range(n))
        best = 0.0
        for c in chains:
            steps = list(zip(c, c[1:]))
            assert all(xs[a] < xs[b] and ys[a] < ys[b] for a, b in steps)
            best = max(best, 6 * len(c) - p.GAP_COST * sum(xs[b] - xs[a] + ys[b] - ys[a] for a, b in steps))
        assert best == pytest.approx(slow_chain(xs, ys, 6, p.GAP_COST))


def test_every_long_stretch_has_a_seed():
    r = np.random.default_rng(3)
    common = r.integers(0, 2**63, 25).astype(np.uint64)
    for _ in range(50):
        a, b = (r.integers(0, 2**63, n).astype(np.uint64) for n in r.integers(0, 90, 2))
        one = set(p.seeds_of(np.concatenate([a, common, b]), 6, 20)[0].tolist())
        two = set(p.seeds_of(np.concatenate([b, common, a]), 6, 20)[0].tolist())
        assert one & two
    # the least of each window, by hand
    numbers = r.integers(0, 2**63, 70).astype(np.uint64)
    seeds, places = p.seeds_of(numbers, 6, 20)
    runs = {i: p.seeds_of(numbers[i : i + 6], 6, 20)[0][0] for i in range(65)}
    assert set(places.tolist()) == {min(range(s, s + 20), key=runs.get) for s in range(46)}
    assert all(runs[i] == s for i, s in zip(places.tolist(), seeds, strict=True))


def slow_grid(a, b):
    table = -np.add.outer(np.arange(len(a) + 1), np.zeros(len(b) + 1, dtype=int)) - np.arange(len(b) + 1)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = p.MATCH if a[i - 1] == b[j - 1] else p.MISMATCH
            table[i, j] = max(table[i - 1, j - 1] + step, table[i - 1, j] + p.GAP, table[i, j - 1] + p.GAP)
    table[0] = -np.arange(len(b) + 1)
    return table


def test_alignments_against_a_full_table():
    r = np.random.default_rng(4)
    skipped = 0
    for _ in range(200):
        a, b = r.integers(0, 6, r.integers(1, 25)), r.integers(0, 6, r.integers(1, 25))
        table = slow_grid(a, b)
        assert (np.stack(list(p._rows(a, b))) >> 32 == table).all()
        score, matched = p.align_whole(a, b)
        assert score == table[-1, -1] and matched >= (score + max(len(a), len(b))) / 2
        a, b = r.integers(0, 150, 64), r.integers(0, 150, 64)
        if not p._may_gain(a, b):
            skipped += 1
            assert slow_grid(a, b).max() <= 0
    assert skipped > 20


def test_many_alignments_at_once(monkeypatch):
    """The steps of a table are taken once for all pairs that wait, with the results of each alone."""
    r = np.random.default_rng(5)
    pairs = []
    for _ in range(100):
        a = r.integers(0, 2**31, 150).astype(np.int32)
        b = a[r.random(150) > 0.05].copy()
        b[r.integers(0, len(b), 5)] = -1
        at = [(i, int(np.flatnonzero(b == w)[0])) for i, w in enumerate(a[:130].tolist()) if i % 9 == 0 and (b == w).any()]
        pairs.append((a, b, [[x for x, _ in at]], [[y for _, y in at]], 40, 0.8))
    alone = [p.together([p.passages_of(*pair)])[0] for pair in pairs]
    assert sum(map(bool, alone)) > 90
    tables, rows = [], p._rows
    monkeypatch.setattr(p, "_rows", lambda a, b: tables.append(a.shape) or rows(a, b))
    assert p.together([p.passages_of(*pair) for pair in pairs]) == alone
    assert len(tables) < len(pairs) / 4
    for _ in range(200):  # gaps of all sizes, by a full table
        a, b = r.integers(0, 4, r.integers(1, 60)), r.integers(0, 4, r.integers(1, 60))
        i, j, score, matched = p._answers([(a, b, True)])[0]
        assert (i, j, score, matched) == (len(a), len(b), *p.align_whole(a, b))


def test_seeds_and_hashes_of_many_texts_at_once():
    import xxhash

    r = random.Random(16)
    texts = ["", " . ", "a, b", *(" ".join("xyzäß"[: r.randrange(1, 6)] * r.randrange(1, 9) for _ in range(r.randrange(60))) for _ in range(200))]
    numbers, edges = p.numbers_of_all(texts)
    seeds, places, rows = p.seeds_of_all(numbers, edges, 5, 16)
    for n, text in enumerate(texts):
        own = numbers[edges[n] : edges[n + 1]]
        words = text.lower().replace(".", " ").replace(",", " ").split()
        assert own.tobytes() == b"".join(xxhash.xxh64_digest(w) for w in words)
        alone = p.seeds_of(own, 5, 16)
        assert (seeds[rows == n] == alone[0]).all() and places[rows == n].tolist() == alone[1].tolist()


def test_chains_of_groups_that_span_batches(spark):
    r = random.Random(17)
    rows = [(d, l, r.randrange(300), r.randrange(300)) for d in range(3, 9) for l in range(3) for _ in range(r.randrange(1, 60))]
    rows += [(20, 1, 5 * i, 5 * i + 2) for i in range(80)] * 2
    matches = spark.createDataFrame(rows, "id bigint, leader bigint, x int, y int")
    want = {}
    for d, l in {row[:2] for row in rows}:
        places = sorted({(x, y) for a, b, x, y in rows if (a, b) == (d, l)})
        xs, ys = zip(*places)
        want[d, l] = [[[side[i] for i in c] for c in p.chain(list(xs), list(ys), 5)] for side in (xs, ys)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for records in ("7", size):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", records)
            assert {(c.id, c.leader): [c.xs, c.ys] for c in p._chains(matches, "bigint", 5).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_alignment_of_any_size():
    a = np.arange(6000)
    b = np.concatenate([a[:2000], a[2100:]])
    assert p.align_whole(a, b) == (5900 - 100, 5900) == p.align_whole(b, a)


def found(spark, rows, **options):
    return p.shared_passages(docs(spark, rows, extra=True), **options).collect()


def test_passages_exact_edited_and_none(spark):
    r = random.Random(2)
    passage = prose(r, 60)
    edited = [*passage[:20], "changed", *passage[21:33], *passage[34:50], "put", "in", *passage[50:]]
    rows = [(100 + i, " ".join(prose(r, 150))) for i in range(40)] + ODD
    rows += [(200, " ".join(prose(r, 70) + passage + prose(r, 30)))]
    rows += [(201, " ".join(prose(r, 10) + edited)), (202, " ".join(passage).upper().replace(" ", ", "))]
    rows += [(203, " ".join(passage[:30] + prose(r, 40)))]  # too short
    rows += [(204, "over and " * 300), (205, "over and " * 200)]  # says little
    rows += [(206, " ".join(prose(r, 20) + passage + prose(r, 20) + passage))]  # twice in one document
    result = {(x.doc_id, x.start_word, x.end_word): x for x in found(spark, rows)}
    assert {(d, x.match_doc_id) for (d, *_), x in result.items()} == {(201, 200), (202, 200), (206, 200)}
    assert (202, 0, 60) in result and (201, 10, 71) in result
    assert {k for k in result if k[0] == 206} == {(206, 20, 80), (206, 100, 160)}
    exact, near = result[202, 0, 60], result[201, 10, 71]
    assert (exact.match_start, exact.match_end, exact.matched) == (70, 130, 60)
    assert (near.match_start, near.match_end, near.matched) == (70, 130, 58)


def test_hot_passage_gives_one_row_a_copy(spark):
    r = random.Random(5)
    passage = prose(r, 55)
    rows = [(i, " ".join([f"own{i}x{j}" for j in range(12)] + passage)) for i in range(400)] + [(i, " ".join(passage)) for i in (900, 900, 901)]
    result = found(spark, rows)
    assert len(result) == 401
    assert {x.match_doc_id for x in result} == {0} and {x.doc_id for x in result} == {*range(1, 400), 900, 901}


@pytest.mark.parametrize("size, gap", [(60, 60), (60, 100), (100, 200), (200, 300), (200, 1000)])
def test_two_passages_with_other_text_between(spark, size, gap):
    r = random.Random(size + gap)
    head, foot = prose(r, size), prose(r, size)
    rows = [(i, " ".join([*head, *(f"own{i}x{j}" for j in range(gap)), *foot])) for i in range(3)]
    result = {(x.doc_id, x.match_doc_id, x.start_word, x.end_word, x.match_start, x.matched) for x in found(spark, rows)}
    at = size + gap
    # a seed at a passage's edge may be led by document 1
    assert {(i, *rest) for i, leader, *rest in result if leader == 1} <= {(2, s, s + size, s, size) for s in (0, at)}
    assert {x for x in result if x[1] == 0} == {(i, 0, s, s + size, s, size) for i in (1, 2) for s in (0, at)}


def test_passage_far_beyond_its_matches(spark):
    r = random.Random(9)
    passage = prose(r, 1000)
    rows = [(5, " ".join(passage)), (9, " ".join([*prose(r, 20), *passage]))]
    alone = [(x.start_word, x.end_word, x.matched) for x in found(spark, rows)]
    assert alone == [(20, 1020, 1000)]
    # document 1 leads the seeds of the last half; a block of other words is no end
    rows += [(1, " ".join(passage[500:]))]
    assert (9, 5, 20, 1020) in {(x.doc_id, x.match_doc_id, x.start_word, x.end_word) for x in found(spark, rows)}
    numbers = np.arange(200)
    assert p.extend(numbers, np.concatenate([numbers[:50], np.arange(900, 914), numbers[64:]]))[-1][0] == 200


def test_first_holders_of_fragments(spark):
    r = random.Random(11)
    rows, expected = [], set()
    for at in range(0, 1000, 100):
        one, two = prose(r, 60), prose(r, 60)
        rows += [(at + 1, one[:30]), (at + 2, one[30:]), (at + 8, [*prose(r, 9), *one]), (at + 9, [*one, *prose(r, 9)])]
        # the first holder has the parts in another order
        rows += [(at + 11, two[30:] + two[:30]), (at + 18, two), (at + 19, [*prose(r, 5), *two])]
        expected |= {(at + 9, at + 8, 0, 60), (at + 19, at + 18, 5, 65)}
    result = {(x.doc_id, x.match_doc_id, x.start_word, x.end_word) for x in found(spark, [(i, " ".join(t)) for i, t in rows])}
    assert expected <= result


def test_long_documents_and_empty_table(spark):
    r = random.Random(6)
    body = prose(r, 20_000)
    other = body.copy()
    other[5_000] = "changed"
    result = found(spark, [(1, " ".join(body)), (2, " ".join(other))])
    assert [(x.doc_id, x.match_doc_id, x.start_word, x.end_word, x.matched) for x in result] == [(2, 1, 0, 20_000, 19_999)]
    assert found(spark, []) == []


@pytest.mark.parametrize("rate, least", [(0.05, 0.98), (0.1, 0.95), (0.15, 0.9)])
def test_recall_of_edited_passages(spark, rate, least):
    """Of copies of 60 words that are still four fifths alike, by alignment of the whole copy."""
    r = random.Random(int(rate * 100))
    vocabulary = [f"{x}{i}" for i in range(900) for x in "abc"]
    rows, wanted = [], set()
    for i in range(150):
        passage = r.choices(vocabulary, k=60)
        edited = [f"new{i}x{j}" if r.random() < rate else w for j, w in enumerate(passage)]
        rows.append((i, " ".join([*r.choices(vocabulary, k=50), *passage, *r.choices(vocabulary, k=50)])))
        rows.append((1000 + i, " ".join([*r.choices(vocabulary, k=50), *edited, *r.choices(vocabulary, k=50)])))
        if sum(a == b for a, b in zip(passage, edited)) >= 0.8 * 60:
            wanted.add((1000 + i, i))
    result = found(spark, rows)
    pairs = {(x.doc_id, x.match_doc_id) for x in result}
    assert len(wanted) > 100 and len(pairs & wanted) >= least * len(wanted)
    assert all(x.matched >= 0.8 * max(x.end_word - x.start_word, x.match_end - x.match_start) for x in result)
    assert pairs <= {(1000 + i, i) for i in range(150)}


def test_a_pair_behind_many_holders_of_its_parts(spark):
    """Edited copies, each of whose parts is first held by many other documents."""
    r = random.Random(13)
    rows, wanted, n = [], set(), 0
    for _ in range(15):
        passage = prose(r, 66)
        parts = [passage[i : i + 33] for i in (0, 33)]
        for _ in range(8):
            rows += [(n + i, " ".join(prose(r, 20) + part + prose(r, 20))) for i, part in enumerate(parts)]
            n += 2
        edited = ["changed" if i % 16 == 8 else w for i, w in enumerate(passage)]
        rows += [(n, " ".join(passage)), (n + 1, " ".join(prose(r, 30) + edited))]
        wanted.add((n + 1, n))
        n += 2
    pairs = {(x.doc_id, x.match_doc_id) for x in found(spark, rows)}
    assert len(wanted & pairs) >= 14


def test_holders_in_order_of_context(spark):
    r = random.Random(14)
    words, seeds = {}, []
    for doc in range(60):
        words[doc] = [r.randrange(3) for _ in range(r.randrange(8, 40))]
        seeds += [(r.randrange(2), doc, r.randrange(len(words[doc]) - 5)) for _ in range(2)]
    seeds = sorted(set(seeds))
    rows = spark.createDataFrame(seeds, "seed bigint, id bigint, place int").repartition(5)
    table = spark.createDataFrame(list(words.items()), "id bigint, words array<int>")
    for forward in (True, False):

        def context(doc, place):
            own = words[doc]
            return own[place + 5 :][: p.CONTEXT] if forward else own[:place][::-1][: p.CONTEXT]

        ordered = sorted(seeds, key=lambda s: (s[0], context(s[1], s[2]), s[1], s[2]))
        want = set()
        for (s, a, x), (s2, b, y) in zip(ordered, ordered[1:]):
            if s == s2 and a != b:
                want.add((b, a, y, x) if b > a else (a, b, x, y))
        assert {tuple(m) for m in p._neighbours(rows, table, "bigint", 5, forward).collect()} == want


def test_words_are_shuffled_once_an_alignment(spark, capsys):
    r = random.Random(15)
    texts = {i: prose(r, 90) for i in range(4)}
    texts |= {i + 4: prose(r, 10) + words[:70] for i, words in texts.items()}
    words = spark.createDataFrame([(d, [WORDS.index(w) for w in t]) for d, t in texts.items()], "id bigint, words array<int>")
    rows = [(d, d - 4, [[10, 40]], [[0, 30]]) for d in range(4, 8)]
    chains = spark.createDataFrame(rows, "id bigint, leader bigint, xs array<array<int>>, ys array<array<int>>")
    least = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        aligned = p._aligned(chains, words, "bigint", "doc_id", 5, 112, 40, 0.8)
        assert sorted(tuple(x) for x in aligned.collect()) == [(d, d - 4, 10, 80, 0, 70, 70) for d in range(4, 8)]
        capsys.readouterr()
        aligned.explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", least)
    final = capsys.readouterr().out.split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1


def test_a_step_frees_the_shuffle_files_of_those_before(spark):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before = files()
    one = p.stage_alone(spark.range(1000).repartition(4, "id"), "step")
    held = files() - before
    two = p.stage_alone(one.select((one["id"] + 1).alias("id")).repartition(4, "id"), "step")
    for _ in range(100):
        if not files() & held:
            break
        time.sleep(0.1)
    assert not files() & held
    assert one.count() == two.count() == 1000


def maximal_runs(one, two, least):
    """Places of every common run of words that can't be made longer."""
    out = set()
    for shift in range(-len(one) + 1, len(two)):
        i = max(0, -shift)
        while i < len(one) and i + shift < len(two):
            n = 0
            while i + n < len(one) and i + n + shift < len(two) and one[i + n] == two[i + n + shift]:
                n += 1
            if n >= least:
                out.add((i, i + n))
            i += n + 1
    return out


def test_exact_passages_by_brute_force(spark):
    """Documents made of shared pieces: whatever two of them have in common is found in each
    but its first holder."""
    r = random.Random(12)
    pieces = [[f"p{i}w{j}" for j in range(r.randrange(45, 90))] for i in range(12)]
    texts = {}
    for doc in range(60):
        words = []
        for n in range(r.randrange(1, 5)):
            words += [f"own{doc}x{n}y{j}" for j in range(r.randrange(5, 30))] + r.choice(pieces)
        texts[doc] = words
    covered = {doc: [] for doc in texts}
    for x in found(spark, [(d, " ".join(t)) for d, t in texts.items()]):
        covered[x.doc_id].append((x.start_word, x.end_word))
    for doc, words in texts.items():
        for other in range(doc):
            for start, end in maximal_runs(words, texts[other], 45):
                assert any(s <= start and end <= e for s, e in covered[doc]), (doc, other, start, end)


def test_filter_never_leaves_out(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    frame = spark.createDataFrame([(int(v),) for v in values], "hash bigint")
    bits = bitfilter.build(frame, "hash", 16).value
    assert bitfilter.has(bits, values).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert bitfilter.has(bits, others).mean() < 0.2
