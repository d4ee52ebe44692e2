"""What a job has finished, on shared storage.

A journal is a folder with one small file per finished step.  A file is written under
another name and then renamed, so it is either there as a whole or not at all; a run that
finds it takes the step's facts from it and does not do the step again.  Folders that the
steps make on the way lie in the journal as well.  One run at a time may use a journal.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import SparkSession

from coldshelf.plans.staging import drop_path, path_exists

_STEPS = "steps"


class Journal:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._facts: dict[str, dict[str, Any]] = {}

    def facts(self, step: str) -> dict[str, Any] | None:
        """What a finished step left to know; None if it is not finished."""
        if step not in self._facts:
            text = read_text(self.spark, self._file(step))
            if text is None:
                return None
            self._facts[step] = json.loads(text)
        return self._facts[step]

    def record(self, step: str, facts: dict[str, Any]) -> dict[str, Any]:
        write_text(self.spark, self._file(step), json.dumps(facts))
        self._facts[step] = facts
        return facts

    def once(self, step: str, work: Callable[[], dict[str, Any] | None]) -> dict[str, Any]:
        """Do a step unless it is finished, and give its facts."""
        found = self.facts(step)
        return self.record(step, work() or {}) if found is None else found

    def folder(self, label: str) -> str:
        return f"{self.path}/{label}"

    def fresh(self, label: str) -> str:
        """A folder for a step to write; what an unfinished run left there goes."""
        path = self.folder(label)
        drop_path(self.spark, path)
        return path

    def clear(self) -> None:
        drop_path(self.spark, self.path)
        self._facts = {}

    def _file(self, step: str) -> str:
        return f"{self.path}/{_STEPS}/{step}.json"


def _system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there as a whole or not at all."""
    system, target = _system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.draft")
    stream = system.create(draft)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(draft, target):
        system.delete(draft, False)
        raise RuntimeError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    system, target = _system(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The files with rows in a folder that a job wrote, one for each task at least."""
    system, target = _system(spark, folder)
    if not system.exists(target):
        return []
    names = [f.getPath().getName() for f in system.listStatus(target) if f.isFile()]
    return sorted(f"{folder.rstrip('/')}/{n}" for n in names if not n.startswith(("_", ".")))


def move_files(spark: SparkSession, folder: str, into: str, prefix: str, only: Collection[str] | None = None) -> None:
    """Move every file with rows, or ``only`` some, into another folder of the same file system.

    A file that has arrived is no longer in ``folder``, so a repeated call moves the others.
    """
    system, target = _system(spark, into)
    system.mkdirs(target)
    of = spark._jvm.org.apache.hadoop.fs.Path

    def move(path: str) -> None:
        new = f"{into.rstrip('/')}/{prefix}{path.rsplit('/', 1)[1]}"
        if not system.rename(of(path), of(new)):
            raise RuntimeError(f"{path} could not become {new}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, [f for f in data_files(spark, folder) if only is None or f in only]))
