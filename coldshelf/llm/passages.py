"""Passages that a document shares with an earlier one, also when they were edited.

Words are hashed, and of the runs of ``k`` words those with the least hash in any window of
``window`` runs are seeds, so that two texts with a common stretch of ``window + k - 1``
words choose a common seed.  Runs of fewer than four distinct words are never seeds: a word
said over and over is no passage.  Each seed is led by its first document (the least id); every
other document's seed is joined to it, so a passage in a third of all documents gives as
many matches as it has copies and no pairs among those.  Runs of two successive seeds are
led in the same way, so that documents which share more with each other than with the first
holder of a single seed meet.

Seeds that no passage holds by then are ordered by the words that follow them, all holders
of a seed together, and each is matched with its neighbour: of all holders that is one with
which it has most words in common to the right.  The same is done with the words before
them.  So documents that share a passage meet behind any number of holders of its parts.

The matches of a document with one leader are chained: of two matches in the same order in
both, the later one extends the earlier one's chain at the cost of the words between them.
The best earlier chain is found in a Fenwick tree over the leader's places.  Chains are then
aligned word by word between their matches and beyond both ends, and kept if they are long
and alike enough.  Where an alignment runs on over other text, the widest stretch between two
places where equal words end is taken that is alike enough; a chain that bridges unrelated
text is cut where its two sides differ most until its parts are alike, so several passages
in one order are found one by one.

Defined results: nulls, empty texts and texts of fewer than ``k`` words share nothing.  A
document with a null id is left out, as no row could name it.  Rows repeated with one id are
one document, whose copies in itself don't count.  Long texts are read whole, and gaps of
any size are aligned.  Of equally good ends of a passage the first one counts.  Other
columns of the input are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from coldshelf.llm import bitfilter
from coldshelf.llm.batches import slices, texts
from coldshelf.plans.staging import stage_alone

_PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())
_TABLE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_XXH64 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
SEED_BITS, ID_BITS = 27, 24
LEAST_DISTINCT = 4
RUNGS = (1, 2)  # how many successive seeds make a key; each key has a leader of its own
CONTEXT = 32  # words by which the holders of a seed are ordered
GAP_COST = 0.05
REACH = 64  # words that an alignment looks ahead at a time
MARGINS = (112, 1000, None)  # words beyond the outermost matches; where they end too early, more are taken, at last whole texts
MATCH, MISMATCH, GAP = 1, -1, -1
TOGETHER = 256  # alignments ahead that are done at once
_FILLERS = (1 << 40, 1 << 41)  # no words, as those have 32 bits

Ask = tuple[np.ndarray, np.ndarray, bool]  # words of both sides, REACH of each at most; whether all of them are aligned
Answer = tuple[int, int, int, int]
type Job[Result] = Generator[list[Ask], list[Answer], Result]


def word_numbers(text: str) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased and without ASCII punctuation."""
    return numbers_of_all([text])[0]


def numbers_of_all(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ``word_numbers`` of all texts in a row, and where each text begins and the last one ends."""
    plain = [b" ", *(text.lower().encode().translate(_TABLE) for text in some)]
    data = np.frombuffer(b" ".join(plain) + b" " * 8, dtype=np.uint8)
    turns = np.flatnonzero(np.diff(data != ord(" "))) + 1
    begins, sizes = turns[::2], turns[1::2] - turns[::2]
    edges = np.searchsorted(begins, np.cumsum([len(p) + 1 for p in plain]))
    return _xxh64(data, begins, sizes), edges


def _xxh64(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of ``xxhash.xxh64_digest`` of each word, words of one size at once; 8 bytes follow the last word."""
    out = np.empty(len(begins), dtype=np.uint64)
    one, two, three, four, five = (np.uint64(p) for p in _XXH64)
    # the 8 or 4 bytes that begin at each byte
    eights, fours = (np.ndarray(len(data) - 7, dtype=t, buffer=data, strides=(1,)) for t in ("<u8", "<u4"))

    def turned(hashes: np.ndarray, bits: int) -> np.ndarray:
        return hashes << np.uint64(bits) | hashes >> np.uint64(64 - bits)

    order = np.argsort(np.minimum(sizes, 32).astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(np.minimum(sizes, 32), minlength=33))
    for size in range(1, 32):
        rows = order[ends[size - 1] : ends[size]]
        if not len(rows):
            continue
        at, left = begins[rows], size
        hashes = np.full(len(rows), five + np.uint64(size))
        while left >= 8:
            hashes = turned(hashes ^ turned(eights[at] * two, 31) * one, 27) * one + four
            at, left = at + 8, left - 8
        if left >= 4:
            hashes = turned(hashes ^ fours[at].astype(np.uint64) * one, 23) * two + three
            at, left = at + 4, left - 4
        for i in range(left):
            hashes = turned(hashes ^ data[at + i].astype(np.uint64) * five, 11) * one
        hashes = (hashes ^ hashes >> np.uint64(33)) * two
        hashes = (hashes ^ hashes >> np.uint64(29)) * three
        out[rows] = hashes ^ hashes >> np.uint64(32)
    out.byteswap(inplace=True)  # a digest begins with the highest byte
    for row in order[ends[31] :].tolist():
        word = data[begins[row] : begins[row] + sizes[row]].tobytes()
        out[row] = np.frombuffer(xxhash.xxh64_digest(word), dtype=np.uint64)[0]
    return out


def seeds_of(numbers: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the chosen runs of k words."""
    seeds, places, _ = seeds_of_all(numbers, np.array([0, len(numbers)]), k, window)
    return seeds, places


def seeds_of_all(words: np.ndarray, edges: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and places of the chosen runs of k words of each text, and the text's number."""
    sizes = np.diff(edges)
    # all texts in a row, so far from one another that no window meets two of them
    begins = np.cumsum(sizes + window) - sizes - window
    numbers = np.zeros(int((sizes + window).sum()) + window + k, dtype=np.uint64)
    numbers[np.arange(len(words)) + np.repeat(begins - edges[:-1], sizes)] = words
    count = len(numbers) - k + 1
    runs = np.zeros(count, dtype=np.uint64)
    for i in range(k):
        runs = (runs ^ (runs >> np.uint64(31)) ^ numbers[i : i + count]) * _ODD
    runs ^= runs >> np.uint64(32)
    # runs that repeat few words over and over are no seeds, nor are those that leave their text
    apart = [numbers[: len(numbers) - d] == numbers[d:] for d in range(1, k)]
    again = np.zeros(count, dtype=np.int8)
    for i in range(1, k):
        again += np.logical_or.reduce([apart[i - j - 1][j : j + count] for j in range(i)])
    held = np.maximum(sizes - k + 1, 0)
    plain = _marked(count, begins, held) & (k - again >= min(k, LEAST_DISTINCT))
    runs[~plain] = np.iinfo(np.uint64).max
    least, span = runs, 1
    while span < window:  # the least of a window by doubling
        step = min(span, window - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    # windows within a text, or the only one of a shorter text
    least = np.where(_marked(len(least), begins, np.where(held > 0, np.maximum(held - window + 1, 1), 0)), least, np.uint64(0))
    # the runs that are the least of some window, each once
    low, span = np.concatenate([np.zeros(window - 1, dtype=np.uint64), least, np.zeros(window - 1, dtype=np.uint64)]), 1
    while span < window:
        step = min(span, window - span)
        low = np.maximum(low[: len(low) - step], low[step:])
        span += step
    spots = np.flatnonzero((runs == low[:count]) & plain)
    rows = np.searchsorted(begins, spots, side="right") - 1
    return runs[spots], spots - begins[rows] if len(spots) else spots, rows


def _marked(size: int, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """True at ``counts`` places from each of ``begins``."""
    edges = np.zeros(size + 1, dtype=np.int8)
    some = counts > 0
    edges[begins[some]] = 1
    edges[(begins + counts)[some]] = -1
    return edges[:size].cumsum(dtype=np.int8).view(bool)


def keys_of(seeds: np.ndarray, places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """The seeds and the runs of successive seeds of a text as keys, the place at which each begins,
    the text's number, and of how many seeds it is."""
    keys, at, of = [seeds], [places], [rows]
    for size in RUNGS[1:]:
        count = max(0, len(seeds) - size + 1)
        run = np.full(count, size, dtype=np.uint64)
        for i in range(size):
            run = (run ^ (run >> np.uint64(31)) ^ seeds[i : i + count]) * _ODD
        one = rows[:count] == rows[size - 1 :]
        keys.append((run ^ (run >> np.uint64(32)))[one])
        at.append(places[:count][one])
        of.append(rows[:count][one])
    return np.concatenate(keys), np.concatenate(at), np.concatenate(of), np.repeat(RUNGS, [len(k) for k in keys])


def _seed_rows(docs: DataFrame, kind: str, k: int, window: int, only=None) -> DataFrame:
    """seed, id, place, rung; with ``only`` (a filter of bits) without the seeds that surely aren't in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = keys_of(*seeds_of_all(*numbers_of_all(texts(batch, "text")), k, window))
                if only is not None and len(found[0]):
                    may = bitfilter.has(only.value, found[0])
                    found = tuple(column[may] for column in found)
                seeds, places, rows, rungs = found
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seeds.view(np.int64)),
                        batch.column("id").take(pa.array(rows)),
                        pa.array(places.astype(np.int32)),
                        pa.array(rungs.astype(np.int8)),
                    ],
                    ["seed", "id", "place", "rung"],
                )

    return docs.mapInArrow(run, f"seed bigint, id {kind}, place int, rung tinyint")


# -- chains -------------------------------------------------------------------------


def chain(xs: list[int], ys: list[int], weight: int, gap: float = GAP_COST) -> list[list[int]]:
    """Chains of matches (x, y) that rise in both; each match is in one chain at most.

    A match scores ``weight``, a step costs ``gap`` for each word it passes on either side.
    As that cost is a difference of x + y, the best predecessor of a match is a maximum
    over smaller y, held in a Fenwick tree while x rises.
    """
    order = sorted(range(len(xs)), key=lambda i: (xs[i], -ys[i]))
    ranks = {y: r for r, y in enumerate(sorted(set(ys)), 1)}
    size = len(ranks)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, before = [0.0] * len(xs), [-1] * len(xs)
    for i in order:
        at, best = ranks[ys[i]] - 1, (-1e18, -1)
        while at:
            best = max(best, tree[at])
            at -= at & -at
        reach = best[0] - gap * (xs[i] + ys[i])
        score[i] = weight + max(0.0, reach)
        before[i] = best[1] if reach > 0 else -1
        at, value = ranks[ys[i]], (score[i] + gap * (xs[i] + ys[i]), i)
        while at <= size:
            tree[at] = max(tree[at], value)
            at += at & -at
    used, chains = [False] * len(xs), []
    for i in sorted(range(len(xs)), key=lambda i: -score[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = before[i]
        if links:
            chains.append(links[::-1])
    return chains


def _chains(matches: DataFrame, kind: str, k: int) -> DataFrame:
    """One row per document and leader: the places of the matches of each chain in both."""
    lists = pa.list_(pa.list_(pa.int32()))

    def chained(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        # all rows of some documents and leaders
        if not rows.num_rows:
            return
        starts = _turns(rows)
        x, y = (rows[c].to_numpy() for c in ("x", "y"))
        # runs that begin with the same seed may have the same leader
        fresh = np.ones(len(x), dtype=bool)
        fresh[1:] = (np.diff(x) != 0) | (np.diff(y) != 0)
        fresh[starts] = True
        x, y = x[fresh], y[fresh]
        ends = np.cumsum(fresh)[np.append(starts[1:], len(fresh)) - 1]
        begins = np.append(0, ends[:-1])
        # steps by which a match surely extends the chain of the one before it
        near = np.ones(len(x), dtype=bool)
        near[1:] = (np.diff(x) > 0) & (np.diff(y) > 0) & (GAP_COST * (np.diff(x) + np.diff(y)) < 0.99 * k)
        near[begins] = True
        single = np.logical_and.reduceat(near, begins)
        x, y, out = x.tolist(), y.tolist(), ([], [])
        for begin, end, one in zip(begins.tolist(), ends.tolist(), single.tolist(), strict=True):
            xs, ys = x[begin:end], y[begin:end]
            links = [] if one else chain(xs, ys, k)
            for places, side in zip((xs, ys), out, strict=True):
                side.append([places] if one else [[places[i] for i in c] for c in links])
        heads = rows.select(["id", "leader"]).take(pa.array(starts))
        done = pa.table([heads["id"], heads["leader"], *(pa.array(side, lists) for side in out)], ["id", "leader", "xs", "ys"])
        yield from done.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by id and leader; a group is part of one document, and may go on in the next batch
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            edge = _turns(pa.Table.from_batches([*(b.slice(b.num_rows - 1) for b in held[-1:]), batch]))[-1] - len(held[-1:])
            if edge < 0:  # all of it goes on with what is held
                held.append(batch)
                continue
            yield from chained(pa.Table.from_batches([*held, batch.slice(0, edge)]))
            held = [batch.slice(edge)]
        if held:
            yield from chained(pa.Table.from_batches(held))

    sorted_rows = matches.select("id", "leader", "x", "y").repartition("id").sortWithinPartitions("id", "leader", "x", "y")
    return sorted_rows.mapInArrow(run, f"id {kind}, leader {kind}, xs array<array<int>>, ys array<array<int>>")


def _turns(rows: pa.Table) -> np.ndarray:
    """Where another document or leader begins, the first row included."""
    rows = rows.select(["id", "leader"]).combine_chunks()
    one, two = rows.slice(0, rows.num_rows - 1), rows.slice(1)
    other = pc.or_(*(pc.not_equal(one[c], two[c]) for c in ("id", "leader")))
    return np.append(0, np.flatnonzero(other.to_numpy()) + 1)


# -- alignment ----------------------------------------------------------------------


# a score and, below it, the number of matches that reach it: the greater one is the better
_UNIT = np.int64(1) << 32
_MATCHED = _UNIT - 1


def _rows(a: np.ndarray, b: np.ndarray) -> Iterator[np.ndarray]:
    """Global alignments of each prefix of a, from none to all, with all prefixes of b.

    With two dimensions each row of a is aligned with the same row of b.
    """
    slope = -GAP * _UNIT * np.arange(b.shape[-1] + 1)
    row = np.zeros((*b.shape[:-1], 1), dtype=np.int64) - slope
    yield row
    for word in np.moveaxis(a, -1, 0):
        above, row = row, row + GAP * _UNIT
        step = np.where(b == word[..., None], MATCH * _UNIT + 1, MISMATCH * _UNIT)
        row[..., 1:] = np.maximum(row[..., 1:], above[..., :-1] + step)
        row += slope
        np.maximum.accumulate(row, axis=-1, out=row)
        row -= slope
        yield row


def align_whole(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Score and matches of the best global alignment, row by row, so that any size will do."""
    if len(b) > len(a):
        a, b = b, a
    for row in _rows(a, b):
        pass
    return int(row[-1] >> 32), int(row[-1] & _MATCHED)


def _may_gain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether any alignment of prefixes could score above zero; for each row if there are many.

    One of prefixes of at most n words has n columns at least, so it needs more than n / 2
    matches, and no more words of a than have an equal one among n words of b can match.
    """
    same = a[..., :, None] == b[..., None, :]
    first = np.where(same.any(axis=-1), same.argmax(axis=-1), REACH)
    # the words of a that have an equal one among as many words of b, for each number of them
    within = np.maximum(first, np.arange(a.shape[-1])).reshape(-1, a.shape[-1])
    spot = within + (REACH + 1) * np.arange(len(within))[:, None]
    known = np.bincount(spot.ravel(), minlength=(REACH + 1) * len(within)).reshape(-1, REACH + 1)[:, :REACH].cumsum(axis=1)
    return (2 * known > np.arange(1, REACH + 1)).any(axis=1).reshape(a.shape[:-1])


def _padded(parts: Sequence[np.ndarray], width: int, filler: int) -> np.ndarray:
    out = np.full((len(parts), width), filler, dtype=np.int64)
    for row, part in zip(out, parts, strict=True):
        row[: len(part)] = part
    return out


def _answers(asks: list[Ask]) -> list[Answer]:
    """Of each ask the prefixes of both sides that align best, none if no score is above zero, or
    the whole sides; the score and the matches of their alignment.

    Many are aligned at once; the fillers behind shorter sides equal no word.
    """
    out = [(0, 0, 0, 0)] * len(asks)
    sizes = [0 if not whole else max(len(part), len(other)) for part, other, whole in asks]
    order = sorted(range(len(asks)), key=sizes.__getitem__)  # those ahead, then whole sides by size
    begins = sizes.count(0)
    for start in (*range(0, begins, TOGETHER), *range(begins, len(order), TOGETHER)):
        some = order[start : min(start + TOGETHER, begins if start < begins else len(order))]
        width = sizes[some[-1]] or REACH
        a, b = (_padded([asks[n][side] for n in some], width, filler) for side, filler in enumerate(_FILLERS))
        if start < begins:
            may = np.flatnonzero(_may_gain(a, b))
            some, a, b = [some[r] for r in may], a[may], b[may]
        if not some:
            continue
        table = np.stack(list(_rows(a, b)), axis=1).reshape(len(some), -1)
        if start < begins:
            # beyond the end of a side a step only costs, so that the first best place never lies there
            best = (table >> 32).argmax(axis=1)
        else:
            best = np.array([len(asks[n][0]) * (width + 1) + len(asks[n][1]) for n in some])
        value = table[np.arange(len(some)), best]
        for n, at, v in zip(some, best.tolist(), value.tolist(), strict=True):
            if sizes[n] or v >> 32 > 0:
                out[n] = (*divmod(at, width + 1), v >> 32, v & int(_MATCHED))
    return out


def together(jobs: Sequence[Job[Any]]) -> list[Any]:
    """The results of jobs that ask for alignments; what all of them ask for by then is aligned at once."""
    results: list[Any] = [None] * len(jobs)
    answers: list[tuple[int, Any]] = [(n, None) for n in range(len(jobs))]
    while answers:
        waiting, asks = [], []
        for n, answer in answers:
            try:
                own = jobs[n].send(answer)
            except StopIteration as end:
                results[n] = end.value
                continue
            waiting.append((n, len(asks), len(asks) + len(own)))
            asks += own
        given = _answers(asks)
        answers = [(n, given[start:end]) for n, start, end in waiting]
    return results


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words at the start that are equal one by one."""
    n, start, size = min(len(a), len(b)), 0, 4 * REACH
    while start < n:
        differ = a[start : min(n, start + size)] != b[start : min(n, start + size)]
        first = int(differ.argmax())
        if differ[first]:
            return start + first
        start, size = start + size, 2 * size
    return n


def _extend(a: np.ndarray, b: np.ndarray) -> Job[list[tuple[int, int, int]]]:
    """``extend`` as a job for ``together``."""
    x = y = matched = 0
    ends = []
    while True:
        run = _common(a[x:], b[y:])
        x, y, matched = x + run, y + run, matched + run
        ends.append((x, y, matched))
        part, other = a[x : x + REACH], b[y : y + REACH]
        if not len(part) or not len(other):
            return ends
        [(i, j, _, more)] = yield [(part, other, False)]
        if not i and not j:
            return ends
        x, y, matched = x + i, y + j, matched + more


def extend(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """How far a and b can be aligned from their starts: words of a, of b, and matches.

    The last entry is the furthest; those before it are where stretches of equal words end.
    """
    return together([_extend(a, b)])[0]


def gaps_of(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int]) -> Job[list[tuple[int, int]]]:
    """For each step of a chain the score of what differs in it, and its matched words."""
    if len(xs) < 2:
        return []
    out, asks, asked = [], [], []
    x_at, y_at = np.array(xs), np.array(ys)
    equal = np.zeros(len(xs) - 1, dtype=bool)
    # stretches of a chain in which the places in both rise alike; most steps are word by word equal
    turns = [0, *(np.flatnonzero(np.diff(x_at - y_at)) + 1).tolist(), len(xs)]
    for first, end in zip(turns, turns[1:]):
        if end - first > 1:
            same = a[xs[first] : xs[end - 1]] == b[ys[first] : ys[end - 1]]
            equal[first : end - 1] = np.logical_and.reduceat(same, x_at[first : end - 1] - xs[first])
    for n, (x, y, x2, y2) in enumerate(zip(xs, ys, xs[1:], ys[1:])):
        if equal[n]:
            out.append((0, x2 - x))
            continue
        part, other = a[x:x2], b[y:y2]
        run = _common(part, other)
        part, other = part[run:], other[run:]
        tail = _common(part[::-1], other[::-1])
        part, other = part[: len(part) - tail], other[: len(other) - tail]
        score, matched = GAP * max(len(part), len(other)), run + tail
        if len(part) and len(other):
            if max(len(part), len(other)) > REACH:
                score, inner = align_whole(part, other)
                matched += inner
            else:
                asks.append((part, other, True))
                asked.append(n)
        out.append((score, matched))
    if asks:
        for n, (_, _, score, inner) in zip(asked, (yield asks), strict=True):
            out[n] = score, out[n][1] + inner
    return out


def passages_of(
    a: np.ndarray, b: np.ndarray, xs: list[list[int]], ys: list[list[int]], least_words: int, least_share: float,
    more: tuple[bool, bool, bool, bool] = (False,) * 4,
) -> Job[list[tuple[int, int, int, int, int]] | None]:
    """Aligned chains, or parts of them, that are long and alike enough; none lies in another one of ``a``.

    A chain that isn't alike enough as a whole is cut at its worst step, and so are its parts.
    ``more`` says whether the texts go on before a, after a, before b, after b; None if an
    alignment came so near to such an end that more words could change it.  A job for ``together``.
    """
    out: list[tuple[int, int, int, int, int]] = []
    for x, y in sorted(zip(xs, ys, strict=True), key=lambda c: -len(c[0])):
        # a document given twice with different texts can have places that its other text lacks
        if x[-1] >= len(a) or y[-1] >= len(b) or not np.array_equal(a[x], b[y]):
            continue
        gaps, parts, back, on = None, [(0, len(x))], {}, {}
        while parts:
            p, q = parts.pop()
            if any(start <= x[p] and x[q - 1] < end for start, end, *_ in out):
                continue
            gaps = (yield from gaps_of(a, b, x, y)) if gaps is None else gaps
            if p not in back:
                back[p] = yield from _extend(a[: x[p]][::-1], b[: y[p]][::-1])
            if q not in on:
                on[q] = yield from _extend(a[x[q - 1] :], b[y[q - 1] :])
            start, start2 = x[p] - back[p][-1][0], y[p] - back[p][-1][1]
            end, end2 = x[q - 1] + on[q][-1][0], y[q - 1] + on[q][-1][1]
            near = (start < REACH, end > len(a) - REACH, start2 < REACH, end2 > len(b) - REACH)
            if any(n and m for n, m in zip(near, more, strict=True)):
                return None
            if min(end - start, end2 - start2) < least_words and q - p == len(x):
                continue
            best, inner = None, sum(m for _, m in gaps[p : q - 1])
            # an alignment may run on over other text; of all places where equal words end the widest will do
            for x_back, y_back, m_back in back[p]:
                for x_on, y_on, m_on in on[q]:
                    span = (x[p] - x_back, x[q - 1] + x_on, y[p] - y_back, y[q - 1] + y_on, m_back + inner + m_on)
                    sizes = span[1] - span[0], span[3] - span[2]
                    if min(sizes) >= least_words and span[4] >= least_share * max(sizes):
                        best = max(best or (0,), (max(sizes), span))
            if best is not None:
                start, end = best[1][:2]
                out = [o for o in out if not (start <= o[0] and o[1] <= end)]
                out.append(best[1])
            elif q - p > 1:
                cut = min(range(p, q - 1), key=lambda i: gaps[i][0]) + 1
                parts += [(cut, q), (p, cut)]
    return out


def _words(docs: DataFrame, kind: str, wanted: Broadcast) -> DataFrame:
    """The words of the documents whose ids may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                own = batch.filter(pa.array(bitfilter.has(wanted.value, batch.column("hash").to_numpy())))
                numbers, edges = numbers_of_all(texts(own, "text"))
                words = (numbers >> np.uint64(32)).astype(np.uint32).view(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words))
                yield pa.RecordBatch.from_arrays([own.column("id"), lists], ["id", "words"])

    return docs.withColumn("hash", F.xxhash64("id")).mapInArrow(run, f"id {kind}, words array<int>")


def _window(words: str, places: str, k: int, margin: int | None) -> tuple[Column, Column]:
    """Where the stretch around all matches begins, and its words; all of them without a margin."""
    if margin is None:
        return F.lit(0), F.col(words)
    begin = F.greatest(F.array_min(F.flatten(places)) - margin, F.lit(0))
    end = F.array_max(F.flatten(places)) + k + margin
    return begin, F.slice(words, begin + 1, end - begin)


def _align(rows: DataFrame, kind: str, id_col: str, least_words: int, least_share: float) -> DataFrame:
    """Passages; a pair whose slices end too early gives one row that has only ids."""
    names = [id_col, f"match_{id_col}", "start_word", "end_word", "match_start", "match_end", "matched"]
    schema = f"`{id_col}` {kind}, `match_{id_col}` {kind}, start_word int, end_word int, match_start int, match_end int, matched int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            sides = [(c.values.to_numpy(), c.offsets.tolist()) for c in (batch.column("own"), batch.column("other"))]
            numbers = [batch.column(c).to_pylist() for c in ("xs", "ys", "own_from", "other_from", "own_size", "other_size")]
            jobs, froms = [], []
            for row, (xs, ys, x0, y0, own_size, other_size) in enumerate(zip(*numbers, strict=True)):
                a, b = (values[offsets[row] : offsets[row + 1]] for values, offsets in sides)
                more = (x0 > 0, x0 + len(a) < own_size, y0 > 0, y0 + len(b) < other_size)
                xs, ys = [[x - x0 for x in c] for c in xs], [[y - y0 for y in c] for c in ys]
                jobs.append(passages_of(a, b, xs, ys, least_words, least_share, more))
                froms.append((x0, y0))
            for row, (passages, (x0, y0)) in enumerate(zip(together(jobs), froms, strict=True)):
                if passages is None:
                    kept.append(row)
                    found.append((None,) * 5)
                    continue
                for start, end, start2, end2, matched in passages:
                    kept.append(row)
                    found.append((start + x0, end + x0, start2 + y0, end2 + y0, matched))
            if kept:
                at = pa.array(kept)
                numbers = [pa.array(c, pa.int32()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("leader").take(at), *numbers], names)

    return rows.mapInArrow(run, schema)


def _aligned(
    chains: DataFrame, words: DataFrame, kind: str, id_col: str, k: int, margin: int | None, least_words: int, least_share: float
) -> DataFrame:
    """The chains aligned within ``margin`` words of their matches, or in whole texts."""
    own_from, own = _window("words", "xs", k, margin)
    near = chains.join(words, "id").select(
        "id", "leader", "xs", "ys", own_from.alias("own_from"), own.alias("own"), F.size("words").alias("own_size")
    )
    other_from, other = _window("words", "ys", k, margin)
    # the words under their own name, so that both joins read one shuffle of them
    leaders = words.alias("words_of")
    both = near.join(leaders, near["leader"] == F.col("words_of.id")).select(
        near["id"], "leader", "xs", "ys", "own_from", "own", "own_size",
        other_from.alias("other_from"), other.alias("other"), F.size("words").alias("other_size"),
    )
    return _align(both, kind, id_col, least_words, least_share)


def _leaders(rows: DataFrame) -> DataFrame:
    """For each seed of two documents or more the first one, and its first place there."""
    firsts = rows.groupBy("seed").agg(F.min(F.struct("id", "place")).alias("first"), F.max("id").alias("last"))
    return firsts.where("first.id < last").select("seed", F.col("first.id").alias("leader"), F.col("first.place").alias("y"))


def _neighbours(rows: DataFrame, words: DataFrame, kind: str, k: int, forward: bool) -> DataFrame:
    """Matches of each place with the one before it, when all holders of a seed are ordered by
    the words behind it (or, backwards, by those before it)."""
    after = F.slice("words", F.col("place") + k + 1, CONTEXT)
    size = F.least(F.col("place"), F.lit(CONTEXT))
    context = after if forward else F.reverse(F.slice("words", F.col("place") - size + 1, size))
    # written, as the ranges are found by a pass of their own
    placed = stage_alone(rows.join(words, "id").select("seed", context.alias("context"), "id", "place"), "placed")
    # a seed that very many documents hold spreads over partitions, as contexts and ids differ
    ordered = placed.repartitionByRange("seed", "context", "id").sortWithinPartitions("seed", "context", "id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        names = ["seed", "id", "place", "other", "other_place", "edge"]
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([*([last] if last is not None else []), batch]).combine_chunks()
            one, two = whole.slice(0, whole.num_rows - 1), whole.slice(1)
            met = pc.and_(pc.equal(one["seed"], two["seed"]), pc.not_equal(one["id"], two["id"]))
            pairs = [*(two[c] for c in ("seed", "id", "place")), one["id"], one["place"]]
            out = pa.Table.from_arrays([*pairs, pa.nulls(len(met), pa.int32())], names).filter(met)
            if last is None:  # the first and the last row of a partition meet others beside it
                out = pa.concat_tables([out, _edge(batch.slice(0, 1), 2 * part, names)])
            last = batch.slice(batch.num_rows - 1)
            yield from out.combine_chunks().to_batches()
        if last is not None:
            yield from _edge(last, 2 * part + 1, names).to_batches()

    schema = f"seed bigint, id {kind}, place int, other {kind}, other_place int, edge int"
    found = stage_alone(ordered.select("seed", "id", "place").mapInArrow(run, schema), "neighbours")
    # two rows a partition; the last of one meets the first of the next
    edges = found.where("edge IS NOT NULL").orderBy("edge").collect()
    across = [
        (b["seed"], b["id"], b["place"], a["id"], a["place"])
        for a, b in zip(edges[1::2], edges[2::2], strict=False)
        if a["seed"] == b["seed"] and a["id"] != b["id"]
    ]
    pairs = found.where("edge IS NULL").drop("edge")
    if across:
        columns = zip(*across, strict=True)
        rows = pa.table([pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(pairs.schema), strict=True)], pairs.columns)
        pairs = pairs.unionByName(found.sparkSession.createDataFrame(rows, pairs.schema))
    later = F.col("id") > F.col("other")
    return pairs.select(
        F.greatest("id", "other").alias("id"),
        F.least("id", "other").alias("leader"),
        F.when(later, F.col("place")).otherwise(F.col("other_place")).alias("x"),
        F.when(later, F.col("other_place")).otherwise(F.col("place")).alias("y"),
    )


def _edge(row: pa.RecordBatch, number: int, names: list[str]) -> pa.Table:
    none = [pa.nulls(1, row.schema.field(c).type) for c in ("id", "place")]
    return pa.Table.from_arrays([*(row.column(c) for c in ("seed", "id", "place")), *none, pa.array([number], pa.int32())], names)


def shared_passages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    window: int = 16,
    least_words: int = 40,
    least_share: float = 0.8,
) -> DataFrame:
    """Passages of at least ``least_words`` words that repeat across documents.

    One row per passage of a document and the earlier document it is led by: both ids, the
    words the passage spans in both, and ``matched`` words.  Passages of one pair that the
    alignment joined appear once.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    leaders = stage_alone(_leaders(_seed_rows(chosen, kind, k, window)), "leaders")
    shared = bitfilter.build(leaders, "seed", SEED_BITS)
    # all holders of shared seeds, the first ones too
    rows = stage_alone(_seed_rows(chosen, kind, k, window, shared).join(leaders, "seed").distinct(), "holders")
    wanted = bitfilter.build(rows.select(F.xxhash64("id").alias("hash")).distinct(), "hash", ID_BITS)
    words = stage_alone(_words(chosen, kind, wanted), "words")
    limits = (kind, id_col, k, least_words, least_share)
    first = rows.where("id <> leader").select("id", "leader", F.col("place").alias("x"), "y")
    found = _passages(first, words, *limits)
    for forward in (True, False):
        left = stage_alone(_uncovered(rows.where("rung = 1").select("seed", "id", "place"), found, id_col), "left")
        found = found.unionByName(_passages(_neighbours(left, words, kind, k, forward), words, *limits))
    return _without_implied(stage_alone(found.distinct(), "found"), id_col)


def _passages(
    matches: DataFrame, words: DataFrame, kind: str, id_col: str, k: int, least_words: int, least_share: float
) -> DataFrame:
    """Chains of matches, aligned; written."""
    chains, own, out = stage_alone(_chains(matches, kind, k), "chains"), words, None
    for margin in MARGINS:
        tried = stage_alone(_aligned(chains, own, kind, id_col, k, margin, least_words, least_share), "tried")
        ended = tried.where("start_word IS NOT NULL")
        out = ended if out is None else out.unionByName(ended)
        short = tried.where("start_word IS NULL").select(F.col(id_col).alias("id"), F.col(f"match_{id_col}").alias("leader"))
        if short.isEmpty():
            break
        chains = stage_alone(chains.join(short.distinct(), ["id", "leader"], "left_semi"), "chains")
        # few pairs as a rule: only their words are shuffled again
        needed = chains.select("id").union(chains.select(F.col("leader").alias("id"))).distinct()
        own = words.join(needed, "id", "left_semi")
    return out


def _uncovered(rows: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Places that lie in no passage of their document with an earlier one."""
    spans = found.groupBy(F.col(id_col).alias("id")).agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    inside = F.exists("spans", lambda p: (p["start_word"] <= F.col("place")) & (F.col("place") < p["end_word"]))
    return rows.join(spans, "id", "left").where(~F.coalesce(inside, F.lit(False))).select(*rows.columns)


def _without_implied(found: DataFrame, id_col: str) -> DataFrame:
    """Without rows that two others tell: a stretch of a document that has a passage with an
    earlier leader as well, which that of the row has a passage with itself."""
    other, span = f"match_{id_col}", [id_col, "start_word", "end_word"]
    first = found.groupBy(*span).agg(F.min(other).alias("first_leader"))
    linked = found.select(F.col(id_col).alias(other), F.col(other).alias("first_leader")).distinct()
    return found.join(first, span).join(linked, [other, "first_leader"], "left_anti").select(*found.columns)
