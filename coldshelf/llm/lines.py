"""Quality rules of single texts, and lines that many documents of a host share.

Words are runs of characters other than ASCII white space.  A line is compared by the hash
of its words in lower case with digits made equal; for each host the distinct documents
that hold a line are counted.  Lines above a limit are boilerplate; a document of which too
little is left without them is rejected.

Defined results: a null text has no words and fails the base rules.  A null host is a host
of its own.  Rows with one id are one document: they count once for a line and for their
host, and give repeated results; rows without an id count as one document together.  Long
texts and lines are read whole.  A line exactly at a limit is not above it.  Other columns
of the input are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices, texts
from coldshelf.plans.staging import stage

_WHITE = "\x20\t\n\x0b\x0c\r"
_BLANKS = bytes.maketrans(b"0123456789", b"0000000000")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
MIN_WORDS = 50


def repeated_words(words: list) -> int:
    """How many words lie in a window of three words that the text has twice or more."""
    if len(words) < 6 and len(set(words)) == len(words):
        return 0
    if len(words) < 4:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    n = len(number)
    pairs = ids[:-1] * n + ids[1:]
    pairs = np.unique(pairs, return_inverse=True)[1] if n > 2_000_000 else pairs
    windows = pairs[:-1] * n + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def measure(text: str) -> tuple[int, int, int, int, int, dict[int, int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; words by line hash."""
    raw = text.encode()
    words = raw.split()  # bytes are split at ASCII white space only
    white = sum(map(text.count, _WHITE))
    lines, duplicates, seen = {}, 0, set()
    for line in raw.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        duplicates += line in seen
        seen.add(line)
        key = xxhash.xxh64_intdigest(b" ".join(parts).lower().translate(_BLANKS)) - (1 << 63)
        lines[key] = lines.get(key, 0) + len(parts)
    symbols = len(_SYMBOLS.findall(text))
    return len(words), len(text) - white, symbols, duplicates, repeated_words(words), lines


def measure_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    schema = f"`{id_col}` {kind}, host string, {', '.join(f'{c} bigint' for c in counts)}, lines array<bigint>, sizes array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = [measure(text) for text in texts(batch, "text")]
                arrays = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
                arrays.append(pa.array([list(r[5]) for r in rows], pa.list_(pa.int64())))
                arrays.append(pa.array([list(r[5].values()) for r in rows], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("host"), *arrays], [id_col, "host", *counts, "lines", "sizes"]
                )

    chosen = docs.select(
        F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text")
    )
    return chosen.mapInArrow(run, schema)


def line_frequency(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_documents: int = 100,
    max_share: float = 0.02,
    min_documents: int = 10,
    least_left: float = 0.3,
) -> DataFrame:
    """Base rules and the verdict on each row.

    A line is removed if more than ``max_documents`` distinct documents of its host hold it,
    or more than ``max_share`` of them and than ``min_documents``: the first limit decides in
    large hosts, the second in small ones, where few documents are many of all.  A row is
    kept if it passes the base rules and at least ``least_left`` of its words are left.
    Returns the id, the counts, ``base_failed``, ``kept`` and ``n_common_words`` (words
    removed).
    """
    found = stage(
        measure_lines(docs, id_col, text_col, host_col).withColumn("row", F.monotonically_increasing_id()), "lines"
    )
    host = F.coalesce(F.concat(F.lit("="), "host"), F.lit("")).alias("host")
    lines = found.select(
        host, F.col(id_col).alias("doc"), "row", F.explode(F.arrays_zip("lines", "sizes")).alias("line")
    ).select("host", "doc", "row", F.col("line.lines").alias("line"), F.col("line.sizes").alias("size"))
    hosts = found.select(host, F.col(id_col).alias("doc")).distinct().groupBy("host").agg(F.count("*").alias("n_host"))
    few = F.greatest(F.lit(float(min_documents)), max_share * F.col("n_host"))
    common = stage(
        lines.groupBy("host", "line", "doc").agg(F.lit(1).alias("one"))
        .groupBy("host", "line").agg(F.count("*").alias("n"))
        .where(F.col("n") > min(min_documents, max_documents))
        .join(hosts, "host").where((F.col("n") > max_documents) | (F.col("n") > few))
        .select("host", "line"),
        "common",
    )
    removed = lines.join(common, ["host", "line"]).groupBy("row").agg(F.sum("size").alias("removed"))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return found.join(removed, "row", "left").select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & (left >= least_left * F.col("n_words"))).alias("kept"),
        F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_common_words"),
    )
