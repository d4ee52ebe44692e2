import random
import zlib

import numpy as np

from coldshelf.llm import toxicity as t
from llm.cases import ODD, docs

BAD = ["vilex", "grotty", "scumbo", "nastor", "wretcho"]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n, seed=1):
    r = random.Random(seed)
    rows, toxic = [], {}
    for i in range(n):
        words = [f"w{r.randrange(400)}" for _ in range(r.randrange(20, 80))]
        toxic[i] = int(r.random() < 0.15)
        if toxic[i]:
            words += r.choices(BAD, k=3)
            r.shuffle(words)
        rows.append((i, " ".join(words)))
    return rows, toxic


def labels(spark, marks):
    return spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, toxic = corpus(3000)
    r = random.Random(2)
    marked = [i for i in toxic if r.random() < 0.5]
    marks = labels(spark, [(i, 1, toxic[i]) for i in marked] + [(marked[0], 1, toxic[marked[0]]), (None, 1, 1), (10**9, 0, 1)])
    far = [(i if i is None else 50_000 + i, x) for i, x in ODD] + [(60_000, "fine " * 20_000 + " ".join(BAD))]
    found = t.toxicity_scores(docs(spark, rows + far, extra=True), marks).collect()
    assert len(found) == len(rows) + len(far)
    by_id = {x.doc_id: x for x in found}
    right = [by_id[i].predicted == toxic[i] for i in toxic if held_out(i)]
    assert np.mean(right) > 0.97
    assert by_id[60_000].predicted == 1
    for x in found:
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5)
        assert x.held_out == (x.doc_id is not None and held_out(x.doc_id))
    assert by_id[50_001].score == by_id[50_002].score == by_id[50_003].score


def test_held_out_labels_are_never_learnt(spark):
    rows, toxic = corpus(600)
    marks = [(i, 1, y) for i, y in toxic.items()]
    turned = [(i, 1, 1 - y if held_out(i) else y) for i, y in toxic.items()]
    frame = docs(spark, rows + [(1000 + i, x) for i, x in rows])
    one, two = (
        {x.doc_id: x.score for x in t.toxicity_scores(frame, labels(spark, m)).collect()} for m in (marks, turned)
    )
    assert one == two


def test_clean_marks_are_not_needed(spark):
    # toxic marks alone set the prior to its bound; the classifier still parts the texts
    rows, toxic = corpus(800)
    positive = [t.word_hashes(x) for i, x in rows if toxic[i]][:60]
    unlabelled = [t.word_hashes(x) for i, x in rows][300:]
    words = np.unique(np.concatenate(positive))
    model = t.train(positive, unlabelled, 0.15, words)
    scores = model.scores([t.word_hashes(x) for _, x in rows])
    assert np.mean((scores >= 0.5) == np.array([toxic[i] for i, _ in rows], dtype=bool)) > 0.95


def dense_risk(w, positive, unlabelled, prior):
    """The non-negative risk, and the part of it that a step goes down (or up, below zero)."""
    f = lambda x: 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    negative = f(unlabelled).mean() - prior * f(positive).mean()
    toxic = prior * (1 - f(positive)).mean()
    return toxic + max(0.0, negative), (toxic + negative if negative >= 0 else -negative)


def dense_train(positive, unlabelled, prior, epochs, rate, decay):
    """Adam on gradients by finite differences, one weight at a time."""
    k = positive.shape[1]
    w = np.append(np.zeros(k), np.log(prior / (1 - prior)))
    mean, square, below = np.zeros(k + 1), np.zeros(k + 1), 0
    for epoch in range(1, epochs + 1):
        gradient = np.zeros(k + 1)
        sign = 1 if dense_risk(w, positive, unlabelled, prior)[1] == dense_risk(w, positive, unlabelled, prior)[0] else -1
        below += sign < 0
        for i in range(k + 1):
            step = np.zeros(k + 1)
            step[i] = 1e-6
            up, down = (dense_risk(w + s, positive, unlabelled, prior)[1] for s in (step, -step))
            gradient[i] = (up - down) / 2e-6
        gradient[:k] += decay * w[:k]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        w = w - rate * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
        w[:k] = np.maximum(w[:k], 0)
    return w, below


def test_training_against_finite_differences():
    r = np.random.default_rng(3)
    words = np.arange(12, dtype=np.int64) * 1000
    for prior, epochs in ((0.2, 40), (0.6, 60)):
        rows = [words[r.random(12) < 0.4] for _ in range(70)]
        rows = [np.unique(np.append(x, words[:2])) if i < 25 else x for i, x in enumerate(rows)]
        positive, unlabelled = rows[:20], rows[20:]
        dense = [np.array([np.isin(words, x) for x in part], dtype=float) for part in (positive, unlabelled)]
        want, below = dense_train(*dense, prior, epochs, 0.05, 1e-5)
        model = t.train(positive, unlabelled, prior, words, epochs=epochs, rate=0.05, decay=1e-5)
        assert np.allclose(model.weights, want[:-1], atol=2e-3) and abs(model.bias - want[-1]) < 2e-3
        assert below or prior < 0.5  # with the high prior the risk of clean texts falls below zero


def test_carried_columns_and_missing_sides(spark):
    frame = docs(spark, [(1, "a b"), (2, None)], extra=True)
    found = t.toxicity_scores(frame, labels(spark, []), carry=("text", "id", "kept")).collect()
    assert [(x.doc_id, x.text, x.id, x.kept, x.predicted) for x in sorted(found)] == [(1, "a b", "x", 1, 0), (2, None, "x", 1, 0)]
    assert t.toxicity_scores(docs(spark, []), labels(spark, [(1, 1, 1)])).collect() == []
