"""Encoding and decoding with merge-type SentencePiece vocabularies.

A text is cut into symbols, and an agenda of adjacent symbol pairs is worked off by score:
the pair whose joined piece scores best is merged first, the leftmost of equal ones.  No
piece of such a vocabulary has a word start after another character, so the agenda of one
word never meets that of the next, and equal words of a batch are encoded once.  Short
words are merged side by side in numpy, one agenda step per round; long ones by a heap.

Defined results: empty texts and nulls have no ids and decode to the empty text.  Long
texts are encoded whole, and so are words of any length.  Of pairs with equal scores the
leftmost goes first.  Repeated rows are encoded like any other and null ids stay null; an
empty table gives no rows, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices, texts

SPACE = "▁"
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_NONE = np.int64(1) << 62
_LONG = 64
_MEMO_WORDS = 200_000  # a worker remembers the words of so many at least, and of twice as many at most
_AT_ONCE = 32_000  # words that are merged side by side
_SLICE_CHARS = 1_500_000
_SLOT_BITS = 20


class Vocabulary:
    """Pieces, scores and the pairs of symbols that can be merged."""

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, size = self.library, self.library.get_piece_size()
        self.pieces = [lib.id_to_piece(i) for i in range(size)]
        special = [lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if lib.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.surface = [
            "" if lib.is_control(i) else " ⁇ " if lib.is_unknown(i) else p.replace(SPACE, " ")
            for i, p in enumerate(self.pieces)
        ]
        self.unknown = lib.unk_id()
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece crosses a word start")
        scores = np.array([lib.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        pairs = {}
        for piece, merged in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = merged
        self.size = size
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        # a slot holds one pair; pairs whose slot is taken are looked up by bisection
        self.slots = np.full(1 << _SLOT_BITS, -1, dtype=np.int64)
        self.slots[self._slot(self.pair_keys)] = np.arange(len(self.pair_keys))
        self.crowded = np.zeros(1 << _SLOT_BITS, dtype=bool)
        self.crowded[self._slot(self.pair_keys[self.slots[self._slot(self.pair_keys)] != np.arange(len(self.pair_keys))])] = True
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("a piece has a character that is no piece")
        # from this id on a token is its piece's characters
        self.plain_from = 1 + max((i for i in range(size) if special[i]), default=-1)
        # every id as text, followed by a comma, or by the mark that ends a word; its characters likewise
        self.mark = next(c for c in map(chr, range(0xE000, 0xF8FF)) if not any(c in p for p in self.pieces))
        self.id_signs = np.array([f"{i}{end}" for end in (",", self.mark) for i in range(size)], dtype=object)
        self.surface_signs = np.array([f"{t}{end}" for end in ("", self.mark) for t in self.surface], dtype=object)
        # ids of a word, joined by commas, and what they decode to; words of late, and of before
        self.memo: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    # -- one word ---------------------------------------------------------------

    def merge(self, word: str) -> list[int]:
        """Work off the agenda of one word with a heap."""
        symbols: list[str] = list(word)
        left = list(range(-1, len(symbols) - 1))
        right = [*range(1, len(symbols)), -1]
        agenda: list[tuple[int, int, str]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (merged := self.ids.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(agenda, (int(self.rank[merged]), a, symbols[a] + symbols[b]))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while agenda:
            _, a, joined = heapq.heappop(agenda)
            b = right[a]
            if not symbols[a] or b < 0 or symbols[a] + symbols[b] != joined:
                continue  # one of the two was merged meanwhile
            symbols[a], symbols[b] = joined, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [i for s in symbols if s for i in self._ids_of(s)]

    def _ids_of(self, symbol: str) -> list[int]:
        found = self.ids.get(symbol)
        if found is not None:
            return [found]
        return [self.bytes[b] for b in symbol.encode()] if self.bytes else [self.unknown]

    # -- many words -------------------------------------------------------------

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merged pieces, -1 where a pair has none."""
        keys = left * self.size + right
        keys[(left < 0) | (right < 0)] = -1
        slot = self._slot(keys)
        at = self.slots[slot]
        found = np.where((at >= 0) & (self.pair_keys[at] == keys), self.pair_ids[at], -1)
        if len(again := np.flatnonzero((found < 0) & self.crowded[slot])):
            at = np.minimum(np.searchsorted(self.pair_keys, keys[again]), len(self.pair_keys) - 1)
            found[again] = np.where(self.pair_keys[at] == keys[again], self.pair_ids[at], -1)
        return found

    def merge_many(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; every round takes one step of each word's agenda."""
        out: list[list[int]] = [[] for _ in words]
        short = [i for i, w in enumerate(words) if 0 < len(w) <= _LONG]
        for i, w in enumerate(words):
            if len(w) > _LONG:
                out[i] = self.merge(w)
        if not short:
            return out
        joined = "".join([words[i] for i in short])
        codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        known, at = np.unique(codes, return_inverse=True)
        first = np.array([self.ids.get(chr(c), -1 - int(c)) for c in known.tolist()], dtype=np.int64)
        symbols = first[at]
        lengths = np.array([len(words[i]) for i in short], dtype=np.int64)
        owners = np.array(short, dtype=np.int64)

        def order_of(merged: np.ndarray) -> np.ndarray:
            return np.where(merged < 0, _NONE, self.rank[merged] << 32)

        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        merged = np.full(len(symbols), -1, dtype=np.int64)
        merged[:-1] = self._pairs(symbols[:-1], symbols[1:])
        merged[starts + lengths - 1] = -1
        order = order_of(merged)
        while len(owners):
            best = np.minimum.reduceat(order + np.arange(len(symbols)), starts)
            live = best < _NONE
            at = best & 0xFFFFFFFF
            if not live.all():
                keep = np.repeat(live, lengths)
                self._put(out, owners[~live], symbols[~keep], lengths[~live])
                at = (np.cumsum(keep) - 1)[at[live]]
                owners, lengths, symbols, merged, order = owners[live], lengths[live], symbols[keep], merged[keep], order[keep]
                starts = np.cumsum(lengths) - lengths
                if not len(owners):
                    break
            symbols[at] = merged[at]
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            symbols, merged, order = symbols[keep], merged[keep], order[keep]
            at = at - np.arange(len(at))
            lengths = lengths - 1
            starts = starts - np.arange(len(starts))
            merged[at], order[at] = -1, _NONE
            for changed in (at[at < starts + lengths - 1], at[at > starts] - 1):
                merged[changed] = new = self._pairs(symbols[changed], symbols[changed + 1])
                order[changed] = order_of(new)
        return out

    def _put(self, out: list, owners: np.ndarray, symbols: np.ndarray, lengths: np.ndarray) -> None:
        flat, end = symbols.tolist(), 0
        plain = not (symbols < 0).any()
        for owner, length in zip(owners.tolist(), lengths.tolist(), strict=True):
            ids = flat[end : end + length]
            end += length
            if not plain and min(ids) < 0:
                ids = [j for i in ids for j in (self._ids_of(chr(-1 - i)) if i < 0 else (i,))]
            out[owner] = ids

    # -- texts ------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def know(self, words: set[str], check: bool) -> dict[str, tuple[str, str]]:
        """A table that has all these words; new ones are encoded, and with ``check`` held
        against the library."""
        if len(self.memo) > _MEMO_WORDS:
            self.memo, self.older = {}, self.memo
        missing = words.difference(self.memo)
        new = list(missing.difference(self.older))
        again = missing.difference(new)
        self.memo.update(zip(again, map(self.older.__getitem__, again)))
        for start in range(0, len(new), _AT_ONCE):
            self._learn(new[start : start + _AT_ONCE], check)
        return self.memo

    def _learn(self, new: list[str], check: bool) -> None:
        ids = self.merge_many(new)
        if check:
            theirs = self.library.encode([w[1:].replace(SPACE, " ") for w in new], num_threads=1)
            if SPACE in new:  # a lone mark is the library's empty text
                theirs[new.index(SPACE)] = ids[new.index(SPACE)]
            if ids != theirs:
                word, own, other = next(x for x in zip(new, ids, theirs, strict=True) if x[1] != x[2])
                raise ValueError(f"the library encodes {word!r} as {other}, not {own}")
        lengths = np.array(list(map(len, ids)), dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        special = np.flatnonzero(np.minimum.reduceat(flat, ends - lengths) < self.plain_from)
        flat[ends - 1] += self.size
        joined = "".join(self.id_signs[flat].tolist()).split(self.mark)
        spelt = "".join(self.surface_signs[flat].tolist()).split(self.mark)
        for i in special.tolist():
            # a word starts with a space, so no run of bytes goes on in the next one
            spelt[i] = " " + self.decode(ids[i])
        self.memo.update(zip(new, zip(joined, spelt)))

    def encode(self, texts: list[str], check: bool = False) -> list[tuple[str, str]]:
        """For each text its ids, as decimals joined by commas, and what they decode to."""
        split = [self.words(text) for text in texts]
        known, out = self.know(set().union(*split), check), []
        for words in split:
            ids, spelt = zip(*map(known.__getitem__, words)) if words else ((), ())
            out.append((",".join(ids), "".join(spelt)[1:]))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; bytes that are no UTF-8 become U+FFFD one by one."""
        strip = bool(ids) and self.pieces[ids[0]].startswith(SPACE)
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.surface[i] for i in ids])[strip:]
        parts: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i is not None and i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        parts.append(bytes(run[:size]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    parts.append("�")
                    size = 1
                del run[:size]
            if i is not None:
                parts.append(self.surface[i])
        whole = "".join(parts)
        return whole[strip:]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


_OUTPUTS = {
    "n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(),
    "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
}
_SPARK = {"ids": "array<int>", "n_tokens": "bigint"}


def encode_texts(
    docs: DataFrame,
    model: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("ids", "decoded"),
    check: bool = True,
) -> DataFrame:
    """Encode whole texts without begin or end ids, and decode the ids again.

    One row per input row: the id column, then the wanted ``outputs`` out of ``n_tokens``,
    ``ids``, ``decoded``, ``ids_sha256`` (decimal ids joined by commas) and
    ``decoded_sha256``.  ``check`` holds every new word of every Arrow batch against the
    sentencepiece library and fails the job on a difference.  ``model`` must be readable
    under the same path on all executors.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *(f"{o} {_SPARK.get(o, 'string')}" for o in outputs)])

    def encoded(vocab: Vocabulary, whole: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for batch in slices(whole, "text", _SLICE_CHARS):
            columns: dict[str, list] = {o: [] for o in outputs}
            for joined, decoded in vocab.encode(texts(batch, "text"), check):
                if "n_tokens" in columns:
                    columns["n_tokens"].append(joined.count(",") + 1 if joined else 0)
                if "ids" in columns:
                    columns["ids"].append([int(i) for i in joined.split(",")] if joined else [])
                if "decoded" in columns:
                    columns["decoded"].append(decoded)
                if "ids_sha256" in columns:
                    columns["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                if "decoded_sha256" in columns:
                    columns["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            arrays = [batch.column(id_col), *(pa.array(columns[o], _OUTPUTS[o]) for o in outputs)]
            yield pa.RecordBatch.from_arrays(arrays, [id_col, *outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for whole in batches:
            yield from encoded(vocab, whole)

    return docs.select(F.col(id_col), F.col(text_col).alias("text")).mapInArrow(run, schema)
