import random

import numpy as np

from coldshelf.llm import decontamination as d
from llm.cases import ODD, docs

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "so", "ta") for b in ("den", "fal", "gor", "hum", "jin")]


def prose(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


def slow_align(window, item):
    table = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            step = d.MATCH if item[i - 1] == window[j - 1] else d.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] + d.GAP, table[i][j - 1] + d.GAP)
    return max(map(max, table))


def test_alignment_scores():
    r = np.random.default_rng(2)
    for _ in range(60):
        window, item = r.integers(0, 6, r.integers(1, 40)), r.integers(0, 6, r.integers(1, 25))
        score, matched, start, end = d.align(window, item)
        assert score == slow_align(window, item)
        assert matched * d.MATCH >= score and start <= end <= len(window)


def leaks(spark, rows, items, **options):
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, gram string")
    return d.find_leaks(docs(spark, rows, extra=True), table, **options).collect()


def test_exact_edited_and_clean(spark):
    r = random.Random(1)
    items = [(i, prose(r, 40)) for i in range(20)] + [(50, None), (51, ""), (52, "two words"), (53, "... !")]
    items += [(60, items[3][1])]
    rows = [(100 + i, prose(r, 200)) for i in range(60)] + ODD
    rows += [(500 + i, prose(r, 90) + " " + items[i][1].upper().replace(" ", ", ") + "! " + prose(r, 70)) for i in range(10)]
    edited = []
    for i in range(10):
        words = items[i][1].split()
        for at in (5, 14, 22, 31):
            words[at] = "changed"
        del words[27]
        edited.append((600 + i, prose(r, 30) + " " + " ".join(words)))
    found = leaks(spark, rows + edited + [rows[-1]], items)
    pairs = {(x.doc_id, x.item_id) for x in found}
    expected = {(500 + i, i) for i in range(10)} | {(600 + i, i) for i in range(10)} | {(503, 60), (603, 60)}
    assert pairs == expected
    assert sum(x.doc_id == rows[-1][0] for x in found) == 2  # the repeated row
    for x in found:
        if x.doc_id < 600:
            assert (x.score, x.matched, x.start_word, x.end_word) == (1.0, 40, 90, 130)
        else:
            assert 0.5 <= x.score < 1


def test_item_in_most_texts_keeps_its_seeds(spark):
    r = random.Random(3)
    items = [(1, prose(r, 30)), (2, prose(r, 30))]
    rows = [(i, prose(r, 50) + " " + items[0][1]) for i in range(40)]
    assert {(x.doc_id, x.item_id) for x in leaks(spark, rows, items)} == {(i, 1) for i in range(40)}


def every_fifth(text):
    return " ".join("edited" if i % 5 == 4 else w for i, w in enumerate(text.split()))


def test_edits_in_every_fifth_word(spark):
    r = random.Random(7)
    items = [(i, prose(r, 40)) for i in range(3)]
    clean = [(i, prose(r, 90)) for i in range(30)]
    alone = [(100, prose(r, 20) + " " + every_fifth(items[0][1]) + " " + prose(r, 20))]
    beside = [(200, items[1][1]), (201, prose(r, 20) + " " + every_fifth(items[1][1]))]
    third = [(300 + i, prose(r, 20) + " " + every_fifth(items[2][1])) for i in range(17)]
    pairs = {(x.doc_id, x.item_id) for x in leaks(spark, clean + alone + beside + third, items)}
    assert pairs == {(100, 0), (200, 1), (201, 1)} | {(300 + i, 2) for i in range(17)}


def test_random_edits_against_alignment_of_all(spark):
    r = random.Random(8)
    items, rows = [(i, prose(r, 40)) for i in range(40)], []
    for i, text in items:
        rate = (0.15, 0.2, 0.25)[i % 3]
        rows.append((i, " ".join(f"edit{j}" if r.random() < rate else w for j, w in enumerate(text.split()))))
    numbers = d.Items.of(items)
    expected = set()
    for i, text in rows:
        window = np.array([numbers.vocabulary.get(w, -1) for w in d.words_of(text)])
        expected |= {(i, k) for k, own in enumerate(numbers.words) if d.align(window, own)[0] >= 0.5 * d.MATCH * 40}
    assert len(expected) > 30
    assert {(x.doc_id, x.item_id) for x in leaks(spark, rows, items)} == expected


def test_blocks_of_items_are_all_items(spark, monkeypatch):
    r = random.Random(4)
    items = [(i, prose(r, 30)) for i in range(12)]
    rows = [(i, prose(r, 50) + " " + items[i][1]) for i in range(12)]
    monkeypatch.setattr(d, "BLOCK_WORDS", 400)
    assert {(x.doc_id, x.item_id) for x in leaks(spark, rows, items)} == {(i, i) for i in range(12)}


def test_ids_of_any_type(spark):
    r = random.Random(9)
    text = prose(r, 30)
    for kind in ("int", "string", "smallint", "decimal(12,0)"):
        items = spark.createDataFrame([(7, text), (None, prose(r, 30))], "item_id int, text string")
        items = items.withColumn("item_id", items.item_id.cast(kind))
        rows = docs(spark, [(1, "x " + text), (None, text)])
        found = d.find_leaks(rows.withColumn("doc_id", rows.doc_id.cast(kind)), items)
        assert found.schema["item_id"].dataType.simpleString() == found.schema["doc_id"].dataType.simpleString() == kind
        assert {(x.doc_id and int(x.doc_id), int(x.item_id)) for x in found.collect()} == {(1, 7), (None, 7)}


def test_empty_tables(spark):
    assert leaks(spark, [], [(1, "a b c d e f g h")]) == []
    assert leaks(spark, [(1, "a b c d e f g h")], []) == []
    assert leaks(spark, [(1, "a b c d e f g h")], [(1, None)]) == []
