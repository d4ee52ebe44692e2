"""Counting quotient filters over sorted fingerprints.

A fingerprint of ``bits`` bits is cut into a quotient, which names its home slot, and a
remainder, which is stored there or in the next free slot to the right.  Remainders of
one quotient form a run, in order; ``occupied`` marks quotients that have a run, ``end``
the last slot of each run.  A count above one follows its remainder as digits of the
slot's width, in slots marked by ``digit``.  So the slots, read from left to right, give
the fingerprints in order, and filters of any sizes merge without loss by merging their
sorted remainders.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

import numpy as np

_HEAD = struct.Struct("<BBII")


def encode(prints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of sorted distinct fingerprints (uint64, below 2^bits) and their counts."""
    quotient_bits = max(1, min(bits - 8, int(len(prints) * 1.2).bit_length()))
    width = bits - quotient_bits
    home = (prints >> np.uint64(width)).astype(np.int64)
    remainder = prints & np.uint64((1 << width) - 1)
    digits = _n_digits(counts, width)
    before = np.cumsum(1 + digits) - (1 + digits)
    # an entry lies at its home slot, or behind what lies there already
    place = np.maximum.accumulate(home - before) + before
    n_slots = max(1 << quotient_bits, int((place + digits).max(initial=0)) + 1)
    occupied, end, digit = (np.zeros(n_slots, dtype=bool) for _ in range(3))
    occupied[home] = True
    last = np.append(home[1:] != home[:-1], True)[: len(home)]
    end[(place + digits)[last]] = True
    slots = np.zeros(n_slots, dtype=np.uint64)
    slots[place] = remainder
    left = counts.astype(np.uint64)
    for k in range(int(digits.max(initial=0))):
        there = digits > k
        slots[place[there] + 1 + k] = left[there] & np.uint64((1 << width) - 1)
        digit[place[there] + 1 + k] = True
        left = left >> np.uint64(width)
    size = -(-width // 8)
    stored = slots.view(np.uint8).reshape(-1, 8)[:, :size]
    marks = [np.packbits(m).tobytes() for m in (occupied, end, digit)]
    return b"".join([_HEAD.pack(bits, quotient_bits, n_slots, len(prints)), *marks, stored.tobytes()])


def _n_digits(counts: np.ndarray, width: int) -> np.ndarray:
    """Digits that follow a remainder; a count of one has none."""
    digits = np.zeros(len(counts), dtype=np.int64)
    left = np.where(counts > 1, counts, 0).astype(np.uint64)
    while left.any():
        digits += left > 0
        left = left >> np.uint64(width)
    return digits


def decode(filter: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter and their counts."""
    bits, quotient_bits, n_slots, n = _HEAD.unpack_from(filter)
    width, at, n_bytes = bits - quotient_bits, _HEAD.size, -(-n_slots // 8)
    marks = []
    for _ in range(3):
        packed = np.frombuffer(filter, dtype=np.uint8, count=n_bytes, offset=at)
        marks.append(np.unpackbits(packed, count=n_slots).astype(bool))
        at += n_bytes
    occupied, end, digit = marks
    size = -(-width // 8)
    stored = np.zeros((n_slots, 8), dtype=np.uint8)
    stored[:, :size] = np.frombuffer(filter, dtype=np.uint8, offset=at).reshape(n_slots, size)
    slots = stored.view(np.uint64).ravel()
    # the run of the i-th occupied quotient ends at the i-th end
    home, ends = np.flatnonzero(occupied), np.flatnonzero(end)
    starts = np.maximum(home, np.append(-1, ends[:-1])[: len(ends)] + 1)
    lengths = ends - starts + 1
    used = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    quotient = np.repeat(home, lengths).astype(np.uint64)
    first = np.flatnonzero(~digit[used])
    prints = (quotient[first] << np.uint64(width)) | slots[used[first]]
    n_digits = np.diff(np.append(first, len(used))) - 1
    counts = np.where(n_digits > 0, 0, 1).astype(np.uint64)
    for k in range(int(n_digits.max(initial=0))):
        there = n_digits > k
        counts[there] |= slots[used[first[there] + 1 + k]] << np.uint64(width * k)
    return prints, counts.astype(np.int64)


def merge(filters: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all filters in order, with the sums of their counts."""
    parts = [decode(f) for f in filters]
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    prints, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])[: len(prints)])
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts
