"""Passages of test items in training texts, found by n-grams and scored by alignment.

Every n-gram of an item is a seed, however many texts hold it: an edit breaks the grams
around it, and any one that is left may be all that an edited copy has.  Where a text holds
a seed, the stretch around it is aligned with the item by Smith and Waterman's local
alignment of words, unless it holds too few of the item's words to reach the least score in
any order.  A text is a leak if its alignment reaches a share of the item's own score, so
edited and partly rewritten copies are found too.

Items are held by every task in blocks of bounded size; each block is one pass over the
texts, and the blocks together are all items.

Defined results: nulls and empty texts match nothing, nor do items of fewer than ``n`` words.
Repeated rows and equal items each give rows of their own, and null ids stay null.  Long
texts are searched whole.  Of equally good stretches of a text the first one counts.  Other
columns of the input are ignored, whatever their names; an empty table on either side gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from coldshelf.llm.batches import slices, texts

_PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_ODD = np.uint64(0x9E3779B97F4A7C15)
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_WORDS = 1_000_000
LEAST_MATCHES = 8


def words_of(text: str) -> list[bytes]:
    """Words in lower case, without ASCII punctuation."""
    return text.lower().encode().translate(_TABLE).split()


@dataclass(frozen=True)
class Items:
    """Test items of one block, as word numbers."""

    ids: list
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @staticmethod
    def of(rows: list) -> Items:
        vocabulary: dict[bytes, int] = {}
        words = [
            np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text or "")], dtype=np.int64)
            for _, text in rows
        ]
        return Items([i for i, _ in rows], words, vocabulary)

    def numbers(self, batch_texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of texts one after the other (-1: in no item), and where each begins."""
        get, flat, starts = self.vocabulary.get, [], [0]
        for text in batch_texts:
            flat += [get(w, -1) for w in words_of(text)]
            starts.append(len(flat))
        return np.array(flat, dtype=np.int64), np.array(starts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(gram, item, place) of every n-gram of every item."""
        parts = [(grams(w, n), i) for i, w in enumerate(self.words) if len(w) >= n]
        if not parts:
            none = np.zeros(0, dtype=np.int64)
            return none.view(np.uint64), none, none
        return (
            np.concatenate([g for g, _ in parts]),
            np.concatenate([np.full(len(g), i) for g, i in parts]),
            np.concatenate([np.arange(len(g)) for g, _ in parts]),
        )


def grams(numbers: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n word numbers; zero where a word is in no item."""
    if len(numbers) < n:
        return np.zeros(0, dtype=np.uint64)
    count = len(numbers) - n + 1
    code = np.zeros(count, dtype=np.uint64)
    known = np.ones(count, dtype=bool)
    for k in range(n):
        part = numbers[k : k + count]
        known &= part >= 0
        code = (code ^ (code >> np.uint64(29)) ^ (part + 1).astype(np.uint64)) * _ODD
    code |= np.uint64(1)
    code[~known] = 0
    return code


def align(window: np.ndarray, item: np.ndarray) -> tuple[int, int, int, int]:
    """Score, matched words, and first and last-plus-one word of the window's best local alignment."""
    width = len(window)
    slope = -GAP * np.arange(width + 1)
    table = np.zeros((len(item) + 1, width + 1), dtype=np.int64)
    same = item[:, None] == window[None, :]
    for i in range(1, len(item) + 1):
        above = table[i - 1]
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(same[i - 1], MATCH, MISMATCH))
        table[i] = np.maximum.accumulate(row + slope) - slope
    i, j = divmod(int(table.argmax()), width + 1)
    score, end, matched = int(table[i, j]), j, 0
    while i and j and table[i, j]:
        here = table[i, j]
        step = MATCH if same[i - 1, j - 1] else MISMATCH
        if here == table[i - 1, j - 1] + step:
            matched += step == MATCH
            i, j = i - 1, j - 1
        elif here == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, matched, j, end


def _hits(codes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram is wanted (sorted), and the number of that gram."""
    there = np.flatnonzero(codes)
    at = np.minimum(np.searchsorted(wanted, codes[there]), len(wanted) - 1)
    right = wanted[at] == codes[there]
    return there[right], at[right]


def _crossing(places: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each place, and whether its n words lie in that text."""
    text = np.searchsorted(starts, places, side="right") - 1
    return text, places + n <= starts[text + 1]


def seeds_of(items: Items, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram, item, place) of every n-gram of each item, sorted by gram."""
    gram, item, place = items.grams(n)
    order = np.lexsort((place, item, gram))
    return gram[order], item[order], place[order]


def _may_reach(window: np.ndarray, item: np.ndarray, flags: np.ndarray, least: float) -> bool:
    """Whether enough of the item's words are in the window at all; ``flags`` is all false, and is so again."""
    there = window[window >= 0]
    flags[there] = True
    found = int(flags[item].sum())
    flags[there] = False
    # a score is at most that of its matches
    return found >= max(least * len(item), min(LEAST_MATCHES, len(item)))


def _leaks_of(
    numbers: np.ndarray, places: np.ndarray, seeds: np.ndarray, of: tuple, items: Items, flags: np.ndarray, least: float
):
    """Leaks in one text: (item, score, matched, start, end, seeds) of the best stretch for each item."""
    gram, item, offset = of
    first, last = np.searchsorted(gram, seeds, "left"), np.searchsorted(gram, seeds, "right")
    counts = last - first
    at = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    found, diagonal = item[at], np.repeat(places, counts) - offset[at]
    order = np.lexsort((diagonal, found))
    found, diagonal = found[order], diagonal[order]
    lengths = np.array([len(items.words[i]) for i in found])
    slack = np.maximum(8, lengths // 4)
    cuts = np.flatnonzero((found[1:] != found[:-1]) | (np.diff(diagonal) > slack[1:])) + 1
    best: dict[int, tuple] = {}
    for a, b in zip([0, *cuts], [*cuts, len(found)], strict=True):
        own, length, room = int(found[a]), int(lengths[a]), int(slack[a])
        start = max(0, int(diagonal[a]) - room)
        window = numbers[start : int(diagonal[b - 1]) + length + room]
        if not _may_reach(window, items.words[own], flags, least):
            continue
        score, matched, i, j = align(window, items.words[own])
        share = score / (MATCH * length)
        if share >= least and matched >= min(LEAST_MATCHES, length) and share > best.get(own, (0,))[0]:
            best[own] = (share, matched, start + i, start + j, int(b - a))
    return [(own, *rest) for own, rest in best.items()]


def _scan(docs: DataFrame, item_kind: DataType, id_col: str, items: Items, n: int, of: tuple, least: float) -> DataFrame:
    id_type, item_type = docs.schema["id"].dataType.simpleString(), item_kind.simpleString()
    wanted = np.unique(of[0])
    item_ids = pa.array(items.ids, to_arrow_type(item_kind))
    names = [id_col, "item_id", "score", "matched", "start_word", "end_word", "n_seeds"]
    schema = f"`{id_col}` {id_type}, item_id {item_type}, score double, matched bigint, start_word bigint, end_word bigint, n_seeds bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(len(items.vocabulary), dtype=bool)
        for whole in batches:
            for batch in slices(whole, "text"):
                numbers, starts = items.numbers(texts(batch, "text"))
                places, found = _hits(grams(numbers, n), wanted)
                text, inside = _crossing(places, starts, n)
                places, found, text = places[inside], found[inside], text[inside]
                rows, leaks = [], []
                for t in np.unique(text).tolist():
                    a, b = np.searchsorted(text, [t, t + 1])
                    own = _leaks_of(
                        numbers[starts[t] : starts[t + 1]], places[a:b] - starts[t], wanted[found[a:b]], of, items, flags, least
                    )
                    rows += [t] * len(own)
                    leaks += own
                if not leaks:
                    continue
                columns = list(zip(*leaks, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)),
                        item_ids.take(pa.array(columns[0])),
                        *(pa.array(c, pa.float64() if k == 0 else pa.int64()) for k, c in enumerate(columns[1:])),
                    ],
                    names,
                )

    return docs.select("id", "text").mapInArrow(run, schema)


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    n: int = 3,
    least_score: float = 0.5,
) -> DataFrame:
    """Every text and test item that align well enough.

    Returns the text's id, ``item_id``, ``score`` (1 for the whole item word by word),
    ``matched`` words, ``start_word`` and ``end_word`` in the text, and ``n_seeds`` hit.
    """
    spark = docs.sparkSession
    texts_in = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type, item_type = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (items, item_col)))
    chosen = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where(
        F.length(F.trim("text")) > 0
    )
    # a text has one word more than half its characters at most
    size = chosen.agg(F.sum(F.length("text") / 2 + 1).alias("size")).first()["size"] or 0
    blocks = int(size // BLOCK_WORDS) + 1
    found = None
    for block in range(blocks):
        part = chosen if blocks == 1 else chosen.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        own = Items.of(sorted(((r["item"], r["text"]) for r in part.collect()), key=str))
        if all(len(w) < n for w in own.words):
            continue
        of = seeds_of(own, n)
        leaks = _scan(texts_in, items.schema[item_col].dataType, id_col, own, n, of, least_score)
        found = leaks if found is None else found.unionByName(leaks)
    if found is None:
        schema = f"`{id_col}` {id_type}, item_id {item_type}, score double, matched bigint, start_word bigint, end_word bigint, n_seeds bigint"
        return spark.createDataFrame([], schema)
    return found
