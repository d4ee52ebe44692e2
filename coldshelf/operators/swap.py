"""Replacing some files of a table's folder by others.

A table here is a flat folder of Parquet files.  New files are written into a journal inside
the folder, where readers do not look, and counted; what is to change is then noted, and only
after that files change places, by renaming.  A swap that broke off is finished by the next
one, or by ``finish_swap``.  While files change places nobody else may read or write the
table; before and after, every reader sees whole files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from coldshelf.plans.journal import Journal, move_files

_JOURNAL = "_shelf"


@dataclass(frozen=True)
class Swap:
    """What changed: names of the files replaced, and rows in them before and after."""

    replaced: tuple[str, ...]
    rows_before: int
    rows_after: int


def flat_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The files of a table and their lengths in bytes."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    seen = [f for f in listed if not f.getPath().getName().startswith(("_", "."))]
    if any(f.isDirectory() for f in seen):
        raise ValueError(f"{path} has folders below it; give each of them")
    return {f.getPath().getName(): f.getLen() for f in seen}


def swap_files(
    spark: SparkSession, path: str, names: Sequence[str], rewrite: Callable[[DataFrame], DataFrame]
) -> Swap:
    """Put what ``rewrite`` makes of some files' rows in place of these files."""
    journal = Journal(spark, f"{path.rstrip('/')}/{_JOURNAL}")
    if not names:
        return Swap((), 0, 0)
    if lost := set(names) - flat_files(spark, path).keys():
        raise ValueError(f"{path} has no files {sorted(lost)}")
    old = spark.read.parquet(*[f"{path.rstrip('/')}/{n}" for n in names])
    rewrite(old).write.parquet(journal.fresh("new"))
    after = spark.read.schema(old.schema).parquet(journal.folder("new")).count()
    facts = {"id": uuid.uuid4().hex[:12], "old": list(names), "before": old.count(), "after": after}
    journal.record("swap", facts)
    return finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> Swap | None:
    """Finish the swap that is noted in a table's folder, if one is."""
    path = path.rstrip("/")
    journal = Journal(spark, f"{path}/{_JOURNAL}")
    facts = journal.facts("swap")
    if facts is None:
        journal.clear()
        return None
    wanted = {f"{path}/{n}" for n in facts["old"]}
    move_files(spark, path, journal.folder("old"), "", only=wanted)
    move_files(spark, journal.folder("new"), path, f"{facts['id']}-")
    journal.clear()
    return Swap(tuple(facts["old"]), facts["before"], facts["after"])
