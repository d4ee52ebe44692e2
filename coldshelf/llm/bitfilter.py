"""A set of hashes as bits: it may let others through, but never leaves one out.

It thins rows before a shuffle; the join behind it decides.  Its size is fixed by ``log2``
and does not grow with the data: over a larger set it lets more rows through.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build(hashes: DataFrame, column: str, log2: int) -> Broadcast:
    """Bits of the low ``log2`` bits of a 64-bit column, on every executor."""
    spot = F.col(column).bitwiseAND(F.lit((1 << log2) - 1).cast("bigint"))
    words = (
        hashes.select(F.shiftright(spot, 6).cast("int").alias("word"), spot.bitwiseAND(F.lit(63).cast("bigint")).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (log2 - 6), dtype=np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the 64-bit hashes may be in the set."""
    spot = hashes.view(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
