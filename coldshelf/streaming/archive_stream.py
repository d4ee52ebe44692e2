"""The archive loop over arriving files.

Each micro-batch takes a few new files, decides each row's side and appends to one
Parquet table partitioned by side.  The file sink commits a batch as a whole under its
number, so a batch that is run again after a failure is not counted twice.

With a keyed destination a batch meets the rows already there: it adds those whose key is
new, or replaces the others.  Each batch keeps a journal under its number until two later
ones have begun, and files arrive by renaming, so a batch that is run again adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from coldshelf.operators.file_deletes import delete_rows_in_files
from coldshelf.operators.merge import new_rows, settle
from coldshelf.operators.predicates import is_match
from coldshelf.plans.journal import Journal, move_files
from coldshelf.plans.staging import drop_path, path_exists

SIDE = "_shelf"


def start_archive_stream(
    spark: SparkSession,
    in_path: str,
    schema: T.StructType,
    where: str,
    out_path: str,
    checkpoint: str,
    per_batch: int = 100,
    sleep: str | None = None,
    format: str = "parquet",
) -> StreamingQuery:
    """Start the loop: drain what is there, or with ``sleep`` look again at that interval."""
    arriving = (
        spark.readStream.schema(schema)
        .format(format)
        .option("maxFilesPerTrigger", per_batch)
        .load(in_path)
    )
    tagged = arriving.withColumn(SIDE, F.when(is_match(where), "archive").otherwise("keep"))
    writer = (
        tagged.writeStream.format("parquet")
        .partitionBy(SIDE)
        .option("checkpointLocation", checkpoint)
        .option("path", out_path)
    )
    trigger = {"processingTime": sleep} if sleep else {"availableNow": True}
    return writer.trigger(**trigger).start()


def archive_stream(
    spark: SparkSession,
    in_path: str,
    schema: T.StructType,
    where: str,
    out_path: str,
    checkpoint: str,
    per_batch: int = 100,
    sleep: str | None = None,
    max_run: float | None = None,
    format: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    """Run the loop to its end, or for ``max_run`` seconds; return ``(archived, kept)``."""
    if sleep and max_run is None:
        raise ValueError("a repeating loop needs max_run; use start_archive_stream otherwise")
    query = start_archive_stream(
        spark, in_path, schema, where, out_path, checkpoint, per_batch, sleep, format
    )
    try:
        query.awaitTermination(max_run) if max_run is not None else query.awaitTermination()
    finally:
        query.stop()
    return stream_side(spark, out_path, schema, "archive"), stream_side(spark, out_path, schema, "keep")


def stream_side(spark: SparkSession, out_path: str, schema: T.StructType, side: str) -> DataFrame:
    """The committed rows of one side."""
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(SIDE, T.StringType())]))
    return table.parquet(out_path).where(F.col(SIDE) == side).drop(SIDE)


def start_keyed_stream(
    spark: SparkSession,
    in_path: str,
    schema: T.StructType,
    where: str,
    dest: str,
    kept_path: str,
    keys: Sequence[str],
    checkpoint: str,
    replace: bool = False,
    order_by: Sequence[str] = (),
    per_batch: int = 100,
    sleep: str | None = None,
    format: str = "parquet",
) -> StreamingQuery:
    """Start a loop that inserts archived rows into a Parquet table with a unique key.

    Of rows with one key the table keeps the first, or with ``replace`` the last to arrive;
    within a batch ``order_by`` decides.  Rows not to be archived are added to ``kept_path``.
    """
    arriving = (
        spark.readStream.schema(schema)
        .format(format)
        .option("maxFilesPerTrigger", per_batch)
        .load(in_path)
    )
    write = keyed_batch(where, dest, kept_path, keys, f"{checkpoint.rstrip('/')}/batches", replace, order_by)
    trigger = {"processingTime": sleep} if sleep else {"availableNow": True}
    writer = arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def keyed_batch(
    where: str,
    dest: str,
    kept_path: str,
    keys: Sequence[str],
    journals: str,
    replace: bool = False,
    order_by: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """What is done with one batch; done again under the same number, it changes nothing."""
    keys, dest, kept_path = list(keys), dest.rstrip("/"), kept_path.rstrip("/")

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        journal = Journal(spark, f"{journals}/{number}")

        def split() -> None:
            batch.withColumn(SIDE, is_match(where)).write.partitionBy(SIDE).parquet(journal.fresh("split"))

        def side(archived: bool) -> DataFrame:
            table = T.StructType([*batch.schema.fields, T.StructField(SIDE, T.BooleanType())])
            return spark.read.schema(table).parquet(journal.folder("split")).where(F.col(SIDE) == archived).drop(SIDE)

        def choose() -> None:
            """Settle which rows go in, before the table changes."""
            rows = side(True)
            if replace:
                rows = settle(rows, [keys], order_by, last=True)
            else:
                there = spark.read.parquet(dest) if path_exists(spark, dest) else rows.limit(0)
                rows = new_rows(there, rows, keys, order_by)
            rows.write.parquet(journal.fresh("chosen"))
            side(False).write.parquet(journal.fresh("kept"))

        def make_room() -> None:
            if replace and path_exists(spark, dest):
                # a key with a NULL conflicts with nothing
                rows = spark.read.schema(batch.schema).parquet(journal.folder("chosen")).dropna(subset=keys)
                delete_rows_in_files(spark, dest, rows, keys)

        def add() -> None:
            move_files(spark, journal.folder("chosen"), dest, f"batch-{number}-")
            move_files(spark, journal.folder("kept"), kept_path, f"batch-{number}-")

        for name, work in (("split", split), ("choose", choose), ("make-room", make_room), ("add", add)):
            journal.once(name, work)
        for label in ("split", "chosen", "kept"):
            drop_path(spark, journal.folder(label))
        drop_path(spark, f"{journals}/{number - 2}")

    return run
