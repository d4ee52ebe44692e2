"""Rewriting a table's files after much of it was removed."""

from __future__ import annotations

import bisect
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coldshelf.operators.swap import Swap, finish_swap, flat_files, swap_files


def compact(
    spark: SparkSession,
    path: str,
    new_path: str,
    target_rows: int = 10_000_000,
    keys: Sequence[str] = (),
    format: str = "parquet",
    target_bytes: int = 512 << 20,
) -> DataFrame:
    """Write the table at ``path`` to ``new_path`` in files of ``target_rows`` rows, and of
    about ``target_bytes`` bytes if that is less.

    With ``keys`` the files hold disjoint key ranges and are sorted, so later seeks skip
    row groups.  Equal keys are spread by the rows' place in the old files.
    """
    if target_rows < 1:
        raise ValueError("a file needs at least one row")
    table = spark.read.format(format).load(path)
    files = max(1, math.ceil(table.count() / target_rows), math.ceil(_size(spark, path) / target_bytes))
    if keys:
        place = [F.col("_metadata.file_path"), _place_in_file(format)]
        placed = table.select("*", *[c.alias(f"_at{i}") for i, c in enumerate(place)])
        rows = (
            placed.repartitionByRange(files, *keys, "_at0", "_at1")
            .sortWithinPartitions(*keys)
            .drop("_at0", "_at1")
        )
    else:
        rows = table.repartition(files)
    rows.write.option("maxRecordsPerFile", target_rows).format(format).save(new_path)
    return spark.read.format(format).schema(table.schema).load(new_path)


def _size(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def _place_in_file(format: str) -> Column:
    """Something that tells rows of a file apart: only Parquet numbers them."""
    return F.col("_metadata.row_index") if format == "parquet" else F.monotonically_increasing_id()


def pack(sizes: Mapping[str, int], target: int) -> list[list[str]]:
    """Names in bins of at most ``target`` bytes: the largest first, each into the fullest
    bin that still takes it; bins of one name are left out.

    A name that is larger than the target goes into no bin.
    """
    rooms: list[tuple[int, int]] = []  # room left and bin, least room first
    bins: list[list[str]] = []
    for name, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        if size > target:
            continue
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
        else:
            room, number = target, len(bins)
            bins.append([])
        bins[number].append(name)
        bisect.insort(rooms, (room - size, number))
    return [sorted(b) for b in bins if len(b) > 1]


def compact_small(
    spark: SparkSession, path: str, small_bytes: int = 32 << 20, target_bytes: int = 512 << 20, keys: Sequence[str] = ()
) -> Swap:
    """Join the small files of the table at ``path`` in place; larger files stay as they are.

    Files of less than ``small_bytes`` are packed into bins of at most ``target_bytes``, and
    each bin becomes one file, sorted by ``keys`` if given.  Only their rows are read.
    """
    if not 0 < small_bytes <= target_bytes:
        raise ValueError("small files must be smaller than what they are joined to")
    finish_swap(spark, path)
    small = {n: size for n, size in flat_files(spark, path).items() if size < small_bytes}
    bins = pack(small, target_bytes)
    names = [n for b in bins for n in b]
    if not names:
        return Swap((), 0, 0)
    bin_of = spark.createDataFrame([(n, i) for i, b in enumerate(bins) for n in b], "_file string, _bin int")

    def joined(rows: DataFrame) -> DataFrame:
        columns = rows.columns
        binned = rows.select("*", F.col("_metadata.file_name").alias("_file")).join(F.broadcast(bin_of), "_file")
        placed = binned.repartitionById(len(bins), F.col("_bin")).select(*columns)
        return placed.sortWithinPartitions(*keys) if keys else placed

    return swap_files(spark, path, names, joined)
