"""Toxicity scores learnt from confirmed toxic texts and unlabelled ones.

The words of a text are a set of 64-bit hashes.  Training takes texts marked toxic and
texts without a mark, never ones marked clean: with a class prior ``p`` the risk is

    p * R(toxic as toxic) + max(0, R(unlabelled as clean) - p * R(toxic as clean)),

the non-negative estimate for positive and unlabelled data.  Where the second part falls
below zero, a step goes the other way, so that the classifier can't fit the unlabelled
toxic texts as clean ones.  Several linear classifiers in numpy learn on shares of the
sample and are averaged.

Defined results: nulls and empty texts get the score of a text without words; long texts are
scored whole.  Repeated rows, and rows without an id, are scored like any other, and texts
with equal words score alike.  A document marked twice is toxic if one mark says so.  Other
columns of the input are ignored, whatever their names; an empty table gives no rows, and
without a toxic or an unlabelled text every score is the prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices, texts
from coldshelf.plans.staging import stage

_PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the distinct words of a text, lower-cased and without ASCII punctuation."""
    words = set(text.lower().encode().translate(_TABLE).split())
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), dtype=">i8").astype(np.int64)


@dataclass(frozen=True)
class Classifier:
    """Weights of known words, in the order of their hashes."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, hashes: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate([*hashes, np.zeros(0, dtype=np.int64)])
        rows = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        total = np.full(len(hashes), self.bias)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
            known = self.words[at] == flat
            total += np.bincount(rows[known], weights=self.weights[at[known]], minlength=len(hashes))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


# -- training -----------------------------------------------------------------------


def _matrix(words: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the known words of each row."""
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.minimum(np.searchsorted(words, flat), len(words) - 1)
    known = words[at] == flat
    return owner[known], at[known]


def train(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    words: np.ndarray,
    *,
    epochs: int = 1500,
    rate: float = 0.05,
    decay: float = 1e-5,
) -> Classifier:
    """A linear classifier over ``words`` (sorted hashes) by the non-negative risk.

    The loss is the sigmoid loss, the steps are Adam's.
    """
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled or not len(words):
        return Classifier(np.zeros(0, dtype=np.int64), np.zeros(0), start)
    (pr, pc), (ur, uc) = _matrix(words, positive), _matrix(words, unlabelled)
    n, m, k = len(positive), len(unlabelled), len(words)
    w = np.zeros(k + 1)
    w[k] = start
    mean, square = np.zeros(k + 1), np.zeros(k + 1)

    def margins(rows: np.ndarray, columns: np.ndarray, count: int) -> np.ndarray:
        return np.bincount(rows, weights=w[columns], minlength=count) + w[k]

    def back(rows: np.ndarray, columns: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(columns, weights=slope[rows], minlength=k), slope.sum())

    for epoch in range(1, epochs + 1):
        fp = 1 / (1 + np.exp(-np.clip(margins(pr, pc, n), -30, 30)))
        fu = 1 / (1 + np.exp(-np.clip(margins(ur, uc, m), -30, 30)))
        # sigmoid loss: a toxic text costs 1 - f, a clean one f
        slope_p, slope_u = fp * (1 - fp) / n, fu * (1 - fu) / m
        negative = fu.mean() - prior * fp.mean()
        rest = back(ur, uc, slope_u) - prior * back(pr, pc, slope_p)
        gradient = -prior * back(pr, pc, slope_p) + rest if negative >= 0 else -rest
        gradient[:k] += decay * w[:k]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        w -= rate * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.999**epoch)) + 1e-8)
        w[:k] = np.maximum(w[:k], 0)  # a word may speak for toxicity only
    return Classifier(words, w[:k], float(w[k]))


def training_rows(docs: DataFrame, id_col: str) -> Column:
    """Rows whose labels may be learnt: crc32 of the decimal id is not divisible by five."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def sample_texts(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str,
    text_col: str,
    label_col: str,
    max_positive: int,
    max_unlabelled: int,
) -> tuple[DataFrame, float]:
    """Words of sampled toxic and unlabelled texts, and the share of toxic labels.

    Rows are (id, toxic, words), written once.  The sample is by hash of the id and no
    larger than the two bounds, so its ids can go to every task and texts are not shuffled.
    The share is counted over all labels that may be learnt.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("mark"))
    marks = marks.where(training_rows(marks, "id") & F.col("mark").isNotNull())
    marks = marks.groupBy("id").agg(F.max("mark").alias("mark"))
    share = marks.agg(F.avg("mark").alias("share")).first()["share"] or 0.0
    ids = docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
    ids = ids.where(training_rows(ids, "id")).join(marks, "id", "left")
    toxic, unknown = ids.where("mark = 1"), ids.where("mark IS NULL")
    place = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30))

    def bounded(rows: DataFrame, most: int) -> DataFrame:
        # a little more than the bound by hash, then the bound
        limit = min(1 << 30, int((1 << 30) * 1.2 * most / max(1, rows.count())) + 1)
        return rows.where(place < limit).orderBy(place, "id").limit(most).select("id")

    chosen = stage(
        bounded(toxic, max_positive).withColumn("toxic", F.lit(1))
        .unionByName(bounded(unknown, max_unlabelled).withColumn("toxic", F.lit(0))),
        "sample",
    )
    texts_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = pa.array([word_hashes(t) for t in texts(batch, "text")], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), words], ["id", "toxic", "words"])

    sampled = texts_in.join(F.broadcast(chosen), "id").select("id", "toxic", "text")
    return stage(sampled.mapInArrow(run, f"id {kind}, toxic int, words array<bigint>"), "words"), float(share)


def choose_words(sample: DataFrame, most: int = 4096, least_texts: int = 4, least_z: float = 4.0) -> np.ndarray:
    """Hashes, sorted, of the ``most`` words that stand out in toxic texts from unlabelled ones.

    ``least_z`` is the least distance of the two shares in standard deviations.
    """
    sizes = sample.agg(F.sum("toxic").alias("n"), F.sum(1 - F.col("toxic")).alias("m")).first()
    n, m = sizes["n"] or 0, sizes["m"] or 0
    if not n or not m:
        return np.zeros(0, dtype=np.int64)
    counts = (
        sample.select("toxic", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("u"))
        .where(F.col("p") >= least_texts)
    )
    middle = (F.col("p") + F.col("u")) / F.lit(float(n + m))
    spread = F.sqrt(middle * (1 - middle) * F.lit(1 / n + 1 / m) + F.lit(1e-12))
    z = (F.col("p") / F.lit(float(n)) - F.col("u") / F.lit(float(m))) / spread
    found = counts.select("word", z.alias("z")).where(F.col("z") > least_z).orderBy(F.desc("z"), "word").limit(most)
    return np.sort(np.array([r["word"] for r in found.collect()], dtype=np.int64))


def _known_words(sample: DataFrame, words: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of every sampled toxic and unlabelled text the chosen words; all that the driver gets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("words")
            known = [w[np.isin(w, words)] for w in (own[i].values.to_numpy() for i in range(len(own)))]
            known = pa.array(known, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"), known], ["id", "toxic", "words"])

    rows = sample.mapInArrow(run, sample.schema).collect()
    rows.sort(key=lambda r: (str(r["id"]), len(r["words"])))  # the same order in every run
    positive, unlabelled = ([np.array(r["words"], dtype=np.int64) for r in rows if r["toxic"] == t] for t in (1, 0))
    return positive, unlabelled


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_positive: int = 6_000,
    max_unlabelled: int = 18_000,
    classifiers: int = 3,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Score every row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Columns named in ``carry`` are handed on between the id and the others.  At most ``max_positive`` toxic and ``max_unlabelled`` unlabelled texts are learnt from.
    """
    sample, share = sample_texts(
        docs, labels, id_col=id_col, text_col=text_col, label_col=label_col,
        max_positive=max_positive, max_unlabelled=max_unlabelled,
    )
    words = choose_words(sample)
    positive, unlabelled = _known_words(sample, words)
    prior = min(0.9, max(0.001, share))
    # each classifier leaves out another share of the unlabelled texts
    models = [
        train(positive, [u for i, u in enumerate(unlabelled) if classifiers == 1 or i % classifiers != c], prior, words)
        for c in range(classifiers)
    ]
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                hashes = [word_hashes(text) for text in texts(batch, "text")]
                score = np.mean([model.scores(hashes) for model in models], axis=0)
                own = [batch.column(c) for c in ("id", *kept, "held_out")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    [id_col, *carry, "held_out", "score", "predicted"],
                )

    # carried columns travel under names that can't clash with the operator's own
    kept = [f"carried_{i}" for i in range(len(carry))]
    chosen = docs.select(
        F.col(id_col).alias("id"),
        *(F.col(c).alias(k) for c, k in zip(carry, kept, strict=True)),
        F.coalesce(~training_rows(docs, id_col), F.lit(False)).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    types = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)
    return chosen.mapInArrow(run, f"`{id_col}` {kind}, {types}held_out boolean, score double, predicted int")
