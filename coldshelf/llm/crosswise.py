"""Aligning the tokens of two tokenizers over a whole corpus.

Texts are shuffled by all their characters, so each distinct text is encoded and aligned
once, with the number of its documents as weight.  Both encodings are laid over the bytes
of a space and the text; where tokens of both end, the text is cut, and the two tokens
that end there are linked.  How often a pair of ids is linked in the corpus is the sum of
its links over distinct texts times their weights.  Each text's measures are then joined
to its documents by the text's SHA-256.

Defined results: null and empty texts, and texts whose tokens do not spell a space and
the text, have no tokens: zeros and an empty digest.  Ties for the most frequent partner
all count.  Repeated rows each get a row.  Long texts are encoded whole.  A null id stays
null.  An empty table gives an empty result.  Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coldshelf.llm.batches import slices
from coldshelf.llm.hot import join_groups
from coldshelf.plans.staging import stage

BROADCAST_PAIRS = 4_000_000  # pairs of ids that every task may hold, in 16 bytes each
_SLICE_CHARS = 500_000
_LONG_RUN = 100_000  # characters without a blank, or of blanks, that only the own library takes


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    unseen = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(unseen)}


class ByteLevel:
    """A byte-level vocabulary: ids of texts, bytes of ids.

    The file's own library is slow, so texts go through a faster one with the same merges.
    The two could only cut a text differently where they class a character differently:
    every new character is tried in both, and texts with one that differs, or with runs too
    long for the fast one, are encoded by the file's own library.
    """

    def __init__(self, path: str, pattern: str) -> None:
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        alphabet = _byte_alphabet()
        n = max(self.own.get_vocab_size(True), 1 + max(model["vocab"].values()))
        self.bytes = [b""] * n
        for token, i in self.own.get_vocab(True).items():
            try:
                self.bytes[i] = bytes(alphabet[c] for c in token)
            except KeyError:
                self.bytes[i] = token.encode()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if set(token) <= set(alphabet)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        merged = [model["vocab"]["".join(m)] for m in merges]
        single = all(bytes([b]) in ranks for b in range(256))
        ordered = single and merged == sorted(merged) and len(ranks) == 256 + len(merged)
        if not ordered:  # ids that are no merge order can't be ranks
            keep = {bytes([b]) for b in range(256)} | {bytes(alphabet[c] for c in "".join(m)) for m in merges}
            ranks = {t: i for t, i in ranks.items() if t in keep}
            ordered = single and merged == sorted(merged) and len(ranks) == 256 + len(set(merged))
        self.fast = tiktoken.Encoding("fast", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if ordered else None
        self.tried: set[str] = set()
        self.differ: set[str] = set()

    def encode(self, texts: list[str]) -> list[list[int]]:
        plain = self._plain(texts)
        slow = [i for i, p in enumerate(plain) if not p]
        out: list[list[int]] = [[]] * len(texts)
        found = self.own.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False) if slow else []
        for i, e in zip(slow, found, strict=True):
            out[i] = e.ids
        for i, p in enumerate(plain):
            if p:
                out[i] = self.fast.encode_ordinary(texts[i])
        return out

    def _plain(self, texts: list[str]) -> list[bool]:
        """Which texts both libraries are known to cut alike."""
        if self.fast is None:
            return [False] * len(texts)
        chars = [set(t) for t in texts]
        new = sorted(set().union(*chars) - self.tried)
        if new:
            trials = [f" a{c}b 1{c}2 .{c}. {c} {c}{c}a{c}1\n{c}" for c in new]
            own = self.own.encode_batch_fast(trials, add_special_tokens=False)
            self.differ.update(
                c for c, t, e in zip(new, trials, own, strict=True) if self.fast.encode_ordinary(t) != e.ids
            )
            self.tried.update(new)
        return [
            self.differ.isdisjoint(c) and (len(t) < _LONG_RUN or _longest_run(t) < _LONG_RUN)
            for t, c in zip(texts, chars, strict=True)
        ]


def _longest_run(text: str) -> int:
    """An upper bound of the longest word or gap: the widest stretch between changes from
    space to other characters or back."""
    space = np.fromiter(map(str.isspace, text), dtype=bool, count=len(text))
    change = np.flatnonzero(np.diff(space))
    return int(np.diff(np.concatenate([[-1], change, [len(text) - 1]])).max(initial=0))


class Pieces:
    """A sentencepiece vocabulary: ids of texts, bytes of ids."""

    def __init__(self, path: str) -> None:
        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.own.get_piece_size()
        pieces = [self.own.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.own.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1)


class Aligner:
    def __init__(self, byte_model: str, pattern: str, piece_model: str) -> None:
        self.a, self.b = ByteLevel(byte_model, pattern), Pieces(piece_model)
        self.n_a, self.n_b = len(self.a.bytes), len(self.b.bytes)
        self.length_a, self.length_b = (np.array([len(x) for x in v.bytes], dtype=np.int64) for v in (self.a, self.b))
        # an id and what follows it: a comma within a side, a bar between the sides, a semicolon behind
        signs = [f"{i}{s}" for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for s in ends for i in range(n)]
        self.signs = np.array(signs, dtype=object)

    def align(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """Tokens, groups and links of each text; links lie one behind the other."""
        a_of, b_of = self.a.encode([" " + t for t in texts]), self.b.encode(texts)
        for i, t in enumerate(texts):
            whole = (" " + t).encode()
            spelt = t and all(
                b"".join([v.bytes[j] for j in ids]) == whole for v, ids in ((self.a, a_of[i]), (self.b, b_of[i]))
            )
            if not spelt:
                a_of[i], b_of[i] = [], []
        counts_a, counts_b = (np.array([len(ids) for ids in x], dtype=np.int64) for x in (a_of, b_of))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64, int(c.sum())) for x, c in ((a_of, counts_a), (b_of, counts_b)))
        # both sides spell the same bytes, so all texts can be laid end to end
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at_end = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, dtype=np.int8)
        at_end[end_a] = 1
        at_end[end_b] += 1
        last_a, last_b = at_end[end_a] == 2, at_end[end_b] == 2
        cut_a, cut_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        # each group's first side comes behind all tokens of the groups before it
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + np.append(0, cut_b + 1)[group_a]] = a + self.n_a * last_a
        order[np.arange(len(b)) + (cut_a + 1)[group_b]] = 2 * self.n_a + b + self.n_b * last_b
        signs = self.signs[order].tolist()
        ends = np.cumsum(counts_a + counts_b).tolist()
        digests, start = [], 0
        for end in ends:
            digests.append(hashlib.sha256("".join(signs[start:end])[:-1].encode()).hexdigest() if end > start else "")
            start = end
        n_groups = np.add.reduceat(np.append(last_a, 0), np.append(0, np.cumsum(counts_a))[:-1]) * (counts_a > 0)
        return {
            "n_a": counts_a, "n_b": counts_b, "n_groups": n_groups.astype(np.int64),
            "groups_sha256": digests, "a": a[last_a], "b": b[last_b],
        }


@cache
def aligner(byte_model: str, pattern: str, piece_model: str) -> Aligner:
    return Aligner(byte_model, pattern, piece_model)


_ALIGNED = pa.schema(
    {
        "sha": pa.binary(), "n": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
        "groups_sha256": pa.string(), "a": pa.list_(pa.int32()), "b": pa.list_(pa.int32()),
    }
)
_ALIGNED_SPARK = (
    "sha binary, n bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, a array<int>, b array<int>"
)


def align_texts(docs: DataFrame, byte_model: str, pattern: str, piece_model: str, text_col: str = "text") -> DataFrame:
    """Each distinct text once: its ``sha``, its ``n`` documents, the number of its tokens on
    both sides and of its groups, a digest of these, and the linked ids ``a`` and ``b``."""
    distinct = docs.groupBy(F.coalesce(text_col, F.lit("")).alias("text")).agg(F.count(F.lit(1)).alias("n"))
    distinct = distinct.select(F.unhex(F.sha2("text", 256)).alias("sha"), "n", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_model, pattern, piece_model)
        for whole in batches:
            for batch in slices(whole, "text", _SLICE_CHARS):
                found = both.align(batch.column("text").to_pylist())
                offsets = pa.array(np.append(0, np.cumsum(found["n_groups"])), pa.int32())
                linked = [pa.ListArray.from_arrays(offsets, pa.array(found[x].astype(np.int32))) for x in "ab"]
                plain = [pa.array(found[x], _ALIGNED.field(x).type) for x in ("n_a", "n_b", "n_groups", "groups_sha256")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("sha").cast(pa.binary()), batch.column("n"), *plain, *linked], _ALIGNED.names
                )

    return distinct.mapInArrow(run, _ALIGNED_SPARK)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Every linked pair ``a``, ``b`` with the ``count`` of its links in the corpus, and whether
    it is the ``best`` of its ``b``: no other ``a`` has a higher count."""
    linked = aligned.select("n", F.inline(F.arrays_zip("a", "b")))
    counts = stage(linked.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    # no more rows than the piece vocabulary has ids
    top = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("top")))
    return counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def align_tokenizers(
    docs: DataFrame,
    byte_model: str,
    pattern: str,
    piece_model: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``.

    ``byte_model`` is a byte-level vocabulary with its ``pattern`` of words, ``piece_model`` a
    sentencepiece one; both must be readable under the same paths on all executors.  Up to
    ``broadcast_pairs`` pairs are looked up in the tasks, more of them by a join.
    """
    aligned = stage(align_texts(docs, byte_model, pattern, piece_model, text_col), "aligned")
    pairs = stage(pair_counts(aligned), "pairs")
    few = pairs.count() <= broadcast_pairs
    sums = _sums_in_tasks(aligned, pairs) if few else _sums_by_join(aligned, pairs)
    measures = stage(sums, "measures")
    text = F.coalesce(text_col, F.lit(""))
    rows = stage(docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha")), "rows")
    zero = F.lit(0).cast("long")
    return join_groups(rows, measures, ["sha"], "n", rows.count()).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),  # at each cut one token of either side ends
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )


_MEASURES = ["sha", "n", "n_a", "n_b", "n_groups", "groups_sha256"]


def _sums_in_tasks(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """Look every link up in a sorted table of all pairs."""
    table = pairs.select(
        F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long")).alias("pair"),
        F.when(F.col("best"), -F.col("count")).otherwise(F.col("count")).alias("signed"),
    ).toArrow()
    keys = table.column("pair").to_numpy()
    order = np.argsort(keys)
    shared = pairs.sparkSession.sparkContext.broadcast((keys[order], table.column("signed").to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, signed = shared.value
        for batch in batches:
            a, b = (batch.column(x) for x in "ab")
            sizes = np.diff(a.offsets.to_numpy())
            wanted = a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy()
            found = signed[np.searchsorted(keys, wanted)]
            # sums over each text's links; a text without links adds nothing
            starts = np.cumsum(sizes) - sizes
            sums = [
                np.where(sizes > 0, np.add.reduceat(np.append(x, 0), starts), 0) if len(sizes) else sizes
                for x in ((found < 0).astype(np.int64), np.abs(found))
            ]
            columns = [batch.column(x) for x in _MEASURES]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(s, pa.int64()) for s in sums)], [*_MEASURES, "n_best", "count_sum"]
            )

    schema = _ALIGNED_SPARK.split(", a array")[0] + ", n_best bigint, count_sum bigint"
    return aligned.mapInArrow(run, schema)


def _sums_by_join(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """Join every link to its pair; pairs with many links are broadcast, the others shuffled."""
    links = aligned.select("sha", F.inline(F.arrays_zip("a", "b"))).groupBy("sha", "a", "b")
    links = stage(links.agg(F.count(F.lit(1)).alias("n_links")), "links")
    of_pair = links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_texts"))
    known = stage(pairs.join(of_pair, ["a", "b"]), "known")
    sums = (
        join_groups(links, known, ["a", "b"], "n_texts", links.count())
        .groupBy("sha")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n_links")).otherwise(0)).alias("n_best"),
            F.sum(F.col("n_links") * F.col("count")).alias("count_sum"),
        )
    )
    return aligned.select(*_MEASURES).join(sums, "sha", "left")
