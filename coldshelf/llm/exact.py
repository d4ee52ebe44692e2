"""Exact duplicates by counting quotient filters and a comparison of bytes.

Every task counts the fingerprints of its rows in quotient filters, one for each range of
fingerprints.  The filters of a range are merged by their sorted remainders; a
fingerprint that occurs more than once sends its texts on, which are then grouped by all
their bytes.  All other texts are unique, and are never shuffled.

Defined results: a null text counts as the empty text, and these are equal to each other.
The row with the largest id stays; rows without an id come last, so one of them stays
only where no equal text has an id.  Rows that agree in text and id are copies too:
exactly one of them stays.  Long texts are hashed and grouped whole.  An empty table gives
an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm import quotient
from coldshelf.llm.hot import is_hot, join_groups
from coldshelf.plans.staging import stage

SHARD_ROWS = 1 << 17  # rows to a range of fingerprints, on average
FILTER_ROWS = 1 << 21  # rows that a task counts before it hands its filters on


def exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    text = F.coalesce(text_col, F.lit(""))
    marks = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64(text).alias("print"),
            F.unhex(F.sha2(text, 256)).alias("sha"),
        ),
        "marks",
    )
    total = marks.count()
    repeated = stage(repeated_prints(marks.select("print"), total), "repeated")
    whole = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("print"), text.alias("text"))
    classes = stage(_equal_texts(whole, repeated, total), "classes")
    found = stage(join_groups(marks, classes, ["print", "sha"], "group_size", total), "found")
    top = F.col("doc_id").eqNullSafe(F.col("keep_id"))

    # rows that agree in text and id: the first of them stays
    twins = found.where(F.col("group_size").isNotNull() & top).groupBy("print", "sha")
    twins = twins.agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n_twins")).where("n_twins > 1")
    twins = stage(twins, "twins")
    if twins.isEmpty():
        found = found.withColumn("first", F.col("row"))
    else:
        found = join_groups(found, twins, ["print", "sha"], "n_twins", total)
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | top & (F.col("row") == F.coalesce("first", "row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def repeated_prints(prints: DataFrame, total: int) -> DataFrame:
    """The fingerprints (``print``, 64 bits) that occur more than once, and their ``n``."""
    shard_bits = max(0, (total // SHARD_ROWS).bit_length())
    low = 64 - shard_bits

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column("print").to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= FILTER_ROWS:
                yield _filters(np.concatenate(held), shard_bits)
                held = []
        if held:
            yield _filters(np.concatenate(held), shard_bits)

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        found, counts = quotient.merge(rows.column("filter").to_pylist())
        more = counts > 1
        shard = np.uint64(key[0].as_py())
        found = found[more] | (shard << np.uint64(low) if shard_bits else np.uint64(0))
        return pa.table({"print": pa.array(found.view(np.int64)), "n": pa.array(counts[more])})

    by_shard = prints.mapInArrow(filters, "shard int, filter binary").groupBy("shard")
    return by_shard.applyInArrow(merged, "print bigint, n bigint")


def _filters(prints: np.ndarray, shard_bits: int) -> pa.RecordBatch:
    """One filter for each range of fingerprints that occurs."""
    low = 64 - shard_bits
    found, counts = np.unique(prints, return_counts=True)
    shard = (found >> np.uint64(low)).astype(np.int64) if shard_bits else np.zeros(len(found), dtype=np.int64)
    rest = found & np.uint64((1 << low) - 1) if shard_bits else found
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[: len(shard)])
    ends = np.append(cuts[1:], len(shard))
    made = [quotient.encode(rest[a:b], counts[a:b], low) for a, b in zip(cuts, ends, strict=False)]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard[cuts], pa.int32()), pa.array(made, pa.binary())], ["shard", "filter"]
    )


def _equal_texts(whole: DataFrame, repeated: DataFrame, total: int) -> DataFrame:
    """Groups of byte for byte equal texts among those with a repeated fingerprint.

    Texts whose fingerprint many rows share are picked by a broadcast of these
    fingerprints and combined before the shuffle, so no task gets all copies of one.
    """

    def grouped(texts: DataFrame) -> DataFrame:
        groups = texts.groupBy("print", "text").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        return groups.where("group_size > 1").select("print", _sha("text"), "keep_id", "group_size")

    hot = F.broadcast(repeated.where(is_hot("n", total)).select("print"))
    rest = repeated.where(~is_hot("n", total)).select("print")
    return grouped(whole.join(hot, "print", "left_semi")).unionByName(
        grouped(whole.join(rest, "print", "left_semi"))
    )


def _sha(text: str) -> Column:
    return F.unhex(F.sha2(text, 256)).alias("sha")
