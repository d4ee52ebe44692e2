"""Intermediate tables on shared storage.

A staged table fixes a result once: whatever executor is lost afterwards, readers see
the same rows.  It is written below ``spark.checkpoint.dir`` so that every node can
read it, and as Parquet so that later passes read only the columns they need.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def workspace(spark: SparkSession) -> str:
    """Shared folder for staged tables, as named by the cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="coldshelf-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].paths.append(path)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_alone(df: DataFrame, label: str = "stage") -> DataFrame:
    """``stage``, and let Spark remove the shuffle files of jobs that are over.

    Spark does so when the driver has collected its garbage, which by itself may be long
    after; steps that each shuffle much would hold the files of all of them by then.  Those
    of the step just written may stay until the next one.
    """
    staged = stage(df, label)
    df.sparkSession._jvm.System.gc()
    return staged


_FEW_ROWS = 100_000
_FEW_BYTES = 64 << 20


def is_few(staged: DataFrame) -> bool:
    """Is a staged table small enough, in rows and bytes, for every task to hold it?"""
    if staged.count() > _FEW_ROWS:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return (staged.agg(size.alias("size")).first()["size"] or 0) <= _FEW_BYTES


def broadcast_if_few(staged: DataFrame) -> DataFrame:
    """Hint a broadcast of a staged table only if it is small.

    Used where the other side has hot keys, which a shuffle would bring together.
    """
    return F.broadcast(staged) if is_few(staged) else staged


class Scratch:
    """Staged tables of one job, removed together when it is over."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def path(self, label: str) -> str:
        path = new_path(self.spark, label)
        if path not in self.paths:
            self.paths.append(path)
        return path

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        for path in self.paths:
            drop_path(self.spark, path)


_scopes: list[Scratch] = []


@contextlib.contextmanager
def staging_scope(spark: SparkSession) -> Iterator[Scratch]:
    """Own every table staged inside the block, and remove them when it is left.

    A DataFrame returned by an operator may read such tables: write or collect it inside
    the block.  Without a block, tables stay until the folder is cleared by its owner.
    """
    scope = Scratch(spark)
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)
        scope.clear()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this job wrote, on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def move_path(spark: SparkSession, path: str, new: str) -> None:
    """Give a folder this job wrote its final name, on the same file system."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, new))
    system = source.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(target) or not system.rename(source, target):
        raise RuntimeError(f"{path} could not become {new}")
