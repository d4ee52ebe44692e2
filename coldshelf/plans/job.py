"""The archive job: split, copy, verify, publish.

The source is read once.  Each row's side is decided in that pass and written beside
``kept_path``, archived and kept rows in folders of their own, so the two sides cannot
disagree about a row.  Rows that a hook spares change sides before anything is copied.
Everything later works from those files, and the source's files are never touched.  What
was written to the destination and to files is looked at before the kept rows appear, as
the last step and as plain files, in ``kept_path`` itself: that folder exists if, and only
if, the job has succeeded, and the caller then switches to it.

Finished steps are noted in a journal.  A job that fails before it has changed anything
outside its own folders leaves nothing behind; one that fails later, or whose driver is
lost, goes on behind its last finished step when it is run again.  Files reach a
destination by renaming, so those that have arrived are not written a second time.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from coldshelf.operators.chunks import key_order, manifest_of, multiply
from coldshelf.operators.compact import compact
from coldshelf.operators.compare import PIECES, row_pieces
from coldshelf.operators.integrity import check_columns, schema_catalog
from coldshelf.operators.merge import common_columns, new_rows, replace_into, settle
from coldshelf.operators.predicates import archive_select, as_column, is_match
from coldshelf.operators.stats import analyze_columns, analyze_table, below_latest
from coldshelf.plans.journal import Journal, move_files
from coldshelf.plans.spec import ArchiveSpec
from coldshelf.plans.staging import Scratch, drop_path, move_path, new_path, path_exists
from coldshelf.sources.dump import csv_line, dump_line, export_dump, header_line, import_dump, write_lines
from coldshelf.sources.endpoints import SourceSpec, jdbc_options, qualified, read_source
from coldshelf.sources.templates import archive_name, fixed_folder, render_name

SIDE = "_shelf"


@dataclass
class Counters:
    """Calls, rows and elapsed time per action."""

    entries: dict[str, list[int]] = field(default_factory=dict)

    @contextlib.contextmanager
    def timed(self, action: str) -> Iterator[None]:
        started = time.monotonic()
        try:
            yield
        finally:
            entry = self.entries.setdefault(action, [0, 0, 0])
            entry[0] += 1
            entry[2] += int((time.monotonic() - started) * 1000)

    def add_rows(self, action: str, rows: int, calls: int = 0) -> None:
        entry = self.entries.setdefault(action, [0, 0, 0])
        entry[0] += calls
        entry[1] += rows

    def add(self, entries: Mapping[str, Sequence[int]]) -> None:
        for action, (calls, rows, ms) in entries.items():
            self.add_rows(action, rows, calls)
            self.entries[action][2] += ms

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(name, *entry) for name, entry in self.entries.items()]
        return spark.createDataFrame(rows, "action string, calls bigint, n_rows bigint, ms bigint")


@dataclass
class ArchiveResult:
    steps: list[str]
    plan: str = ""
    kept_path: str | None = None
    dest_path: str | None = None
    files_path: str | None = None
    manifest: DataFrame | None = None
    progress: DataFrame | None = None
    statistics: DataFrame | None = None
    analysis: dict[str, DataFrame] = field(default_factory=dict)


def archive_condition(source: DataFrame, spec: ArchiveSpec) -> Column:
    """The rows to archive, as a filter that a scan understands."""
    condition = as_column(spec.where)
    return condition & below_latest(source, spec.autoinc_col) if spec.autoinc_col else condition


def archive_match(source: DataFrame, spec: ArchiveSpec) -> Column:
    """Is the row to be archived?  Never NULL."""
    return is_match(archive_condition(source, spec))


def planned_steps(spec: ArchiveSpec) -> list[str]:
    steps = [f"read {spec.source.database}.{spec.source.table}"]
    if spec.dest and spec.check_columns:
        steps.append("check columns against the destination")
    steps.append(f"split by: {spec.where}")
    if spec.autoinc_col:
        steps.append(f"spare the row with the largest {spec.autoinc_col}")
    if spec.keys and not spec.purge:
        steps.append(f"list chunks of {spec.chunk_rows} rows by {', '.join(spec.keys)}")
    if spec.dest:
        mode = "REPLACE" if spec.replace else "INSERT IGNORE" if spec.ignore else "INSERT"
        steps.append(f"{mode} into {spec.dest.path or spec.dest.table}")
    if spec.file:
        steps.append(f"write {spec.output_format} files to {spec.file}")
    steps.append("verify counts and checksums" if spec.verify else "verify counts")
    if not spec.no_delete:
        steps.append(f"publish kept rows at {spec.kept_path}")
    for name in ("optimize", "analyze"):
        if getattr(spec, name):
            steps.append(f"{name} {getattr(spec, name)}")
    return steps


def run_archive(spark: SparkSession, spec: ArchiveSpec) -> ArchiveResult:
    """Run a job, or go on with it where an earlier run of it broke off.

    With ``dry_run`` only say what it would do.
    """
    spec = spec.validated()
    spec._require_apart(spec.dest, lambda path: qualified(spark, path))
    scratch = Scratch(spark)
    if spec.dry_run:
        source = read_source(spark, spec.source).alias(spec.source.table)
        return ArchiveResult(planned_steps(spec), plan=_explained(_chosen(source, spec)))
    lasting = spec.journal_path()
    journal = Journal(spark, lasting or new_path(spark, "job"))
    _open(journal, spec)
    try:
        if not spec.no_delete and path_exists(spark, spec.kept_path) and journal.facts(_PUBLISHING) is None:
            raise ValueError(f"{spec.kept_path} already exists")
        result = _run(spark, spec, journal, scratch)
    except BaseException:
        if not lasting or journal.facts(_TOUCHED) is None:
            _discard(journal)
        raise
    finally:
        scratch.clear()
    journal.clear()
    if spec.hooks.after_finish:
        spec.hooks.after_finish(result.statistics)
    return result


_TOUCHED = "touched"  # noted before the first change outside the job's own folders
_PUBLISHING = "publishing"  # noted before the kept rows get their name


def _open(journal: Journal, spec: ArchiveSpec) -> None:
    """Begin the journal, or check that the one that is there is this job's."""
    begun = journal.facts("begun")
    if begun is not None and begun["job"] != spec.fingerprint():
        if journal.facts(_TOUCHED) is not None:
            raise ValueError(f"another job broke off at {journal.path}; run it again or drop_job it")
        _discard(journal)
    id, at = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).isoformat()
    dest = spec.dest.path.rstrip("/") if spec.dest and spec.dest.path else None
    beside = {name: f"{dest}.{name}-{id}" for name in ("incoming", "replaced", "compact")} if dest else {}
    journal.once("begun", lambda: {"job": spec.fingerprint(), "id": id, "at": at, "beside": beside})


def _beside(journal: Journal, name: str) -> str:
    """A folder beside the destination that only this job knows."""
    return journal.facts("begun")["beside"][name]


def _discard(journal: Journal) -> None:
    for path in (journal.facts("begun") or {}).get("beside", {}).values():
        drop_path(journal.spark, path)
    journal.clear()


def drop_job(spark: SparkSession, journal: str) -> None:
    """Give up a job that broke off: remove what it noted and made on its way.

    What has reached the destination or files by then stays there.
    """
    _discard(Journal(spark, journal))


def _run(spark: SparkSession, spec: ArchiveSpec, journal: Journal, scratch: Scratch) -> ArchiveResult:
    result = ArchiveResult(planned_steps(spec))
    counters = Counters()

    def step(name: str, work: Callable[[], dict | None]) -> dict:
        """Do a step once; a later run takes its facts and counts from the journal."""
        own = Counters()
        facts = journal.once(name, lambda: {"facts": work(own) or {}, "counts": own.entries})
        counters.add(facts["counts"])
        return facts["facts"]

    # under its name, so that a subquery in the predicate can refer to the table
    source = read_source(spark, spec.source).alias(spec.source.table)
    dest = _existing(spark, spec.dest)
    if dest is not None and spec.check_columns:
        _require_same_columns(spark, _outgoing(source, spec), dest)

    if spec.no_delete:
        step("select", lambda own: _copy(source, spec, own, journal))
    else:
        step("select", lambda own: _split(source, archive_match(source, spec), spec, own, journal))
    archived = _archived(spark, source, spec, journal)
    if archived is not None and spec.hooks.before_delete and not spec.no_delete:
        step("spare", lambda own: _spare(archived, spec, own, journal, scratch))
        archived = spark.read.schema(source.schema).parquet(journal.folder("chosen"))

    if archived is not None and not spec.purge:
        if spec.keys:
            ordered = key_order(archived, spec.keys, unique=spec.unique_keys)
            result.manifest = manifest_of(ordered, spec.keys, spec.chunk_rows)
            if spec.progress:
                marks = manifest_of(ordered, spec.keys, spec.progress)
                result.progress = marks.select("rows_done", "hi")
        rows = _outgoing(archived, spec)
        if spec.hooks.before_insert:
            step("hook", lambda own: rows.transform(spec.hooks.before_insert).write.parquet(journal.fresh("hooked")))
            rows = spark.read.parquet(journal.folder("hooked"))
        if spec.dest:
            sent = step("send", lambda own: _prepare(rows, dest, spec, own, journal, scratch))
            journal.once(_TOUCHED, dict)
            step("insert", lambda own: _insert(sent, spec, own, journal))
            result.dest_path = sent["dest_path"]
        if spec.file:
            journal.once(_TOUCHED, dict)
            ts = spec.file_ts
            # the time that routes rows need not be among the columns written
            routed = archived.select(*rows.columns, ts) if ts and ts not in rows.columns else rows
            result.files_path = step("file", lambda own: _write_files(routed, rows.columns, spec, own, journal))["path"]

    # everything else is done and checked: only now the kept rows appear
    if "d" in (spec.optimize or "") and result.dest_path:
        result.dest_path = step("tidy", lambda own: _optimize_dest(spark, spec, result.dest_path, own, journal))["path"]
    if not spec.no_delete:
        journal.once(_TOUCHED, dict)
        result.kept_path = _publish(spark, spec, counters, journal)
    _analyze(spark, spec, result)
    result.statistics = counters.frame(spark)
    return result


def _outgoing(rows: DataFrame, spec: ArchiveSpec) -> DataFrame:
    return archive_select(
        rows, F.lit(True), spec.columns or None, spec.primary_key_only, spec.keys
    )


def _explained(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def _existing(spark: SparkSession, dest: SourceSpec | None) -> DataFrame | None:
    """The destination as it is now; None if it has still to be made."""
    if dest is None:
        return None
    if dest.path:
        if not path_exists(spark, dest.path):
            return None
    elif not dest.url and not spark.catalog.tableExists(f"{dest.database}.{dest.table}"):
        return None
    return read_source(spark, dest)


def _require_same_columns(spark: SparkSession, a: DataFrame, b: DataFrame) -> None:
    """Columns go by name, so only their order may differ."""
    found = check_columns(schema_catalog(spark, a), schema_catalog(spark, b))
    found = found.where("difference <> 'position'").collect()
    if found:
        listed = ", ".join(f"{r['name']} ({r['difference']})" for r in found)
        raise ValueError(f"source and destination columns differ: {listed}")


def _figures(verify: bool) -> list[Column]:
    """Per side the number of rows and, to verify, the sums of checksum pieces."""
    figures = []
    for side in ("archive", "keep"):
        here = F.col(SIDE) == side
        figures.append(F.count_if(here).alias(f"n_rows_{side}"))
        for i in PIECES if verify else ():
            figures.append(F.sum(F.when(here, F.col(f"_p{i}"))).alias(f"sum{i}_{side}"))
    return figures


def _chosen(source: DataFrame, spec: ArchiveSpec) -> DataFrame:
    """The rows to archive with the columns that later steps use.

    Filter and columns stand directly above the scan, which decides and reads no more than
    it must.
    """
    chosen = source.where(archive_condition(source, spec))
    if spec.hooks.before_insert is not None:
        return chosen
    needed = [*_outgoing(source, spec).columns, *spec.keys, *([spec.file_ts] if spec.file_ts else [])]
    return chosen.select(*dict.fromkeys(needed))


def _copy(source: DataFrame, spec: ArchiveSpec, counters: Counters, journal: Journal) -> None:
    """The rows to archive of a job that deletes nothing, written once, so that every later
    step sees the same."""
    seen = Observation()
    with counters.timed("select"):
        chosen = _chosen(source, spec)
        path = journal.fresh("copied")
        chosen.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.parquet(path)
        if source.sparkSession.read.schema(chosen.schema).parquet(path).count() != seen.get["n_rows"]:
            raise RuntimeError("the files written do not hold the rows read")
    counters.add_rows("select", seen.get["n_rows"])


def _split(source: DataFrame, match: Column, spec: ArchiveSpec, counters: Counters, journal: Journal) -> None:
    """Write both sides (or the kept one) in one pass, and check the files against the rows
    that were read."""
    spark = source.sparkSession
    columns = source.columns
    wanted = ["keep"] if _keeps_only(spec) else ["archive", "keep"]
    root = journal.fresh("split")

    def hashed(rows: DataFrame) -> DataFrame:
        if not spec.verify:
            return rows
        return rows.withColumns({f"_p{i}": p for i, p in enumerate(row_pieces(columns))})

    with counters.timed("select"):
        seen = Observation()
        figures = _figures(spec.verify)
        tagged = source.withColumn(SIDE, F.when(match, "archive").otherwise("keep"))
        observed = hashed(tagged).observe(seen, *figures).select(*tagged.columns)
        if len(wanted) == 1:
            observed = observed.where(F.col(SIDE) == wanted[0])
        observed.write.partitionBy(SIDE).parquet(root)

        both = hashed(spark.read.schema(tagged.schema).parquet(root))
        written = both.agg(*figures).first().asDict()
        for name in wanted:
            for figure in [f for f in written if f.endswith(f"_{name}")]:
                if written[figure] != seen.get[figure]:
                    raise RuntimeError(f"the files written do not hold the rows read ({figure})")
            if not written[f"n_rows_{name}"]:  # a side without rows still gets its folder
                spark.createDataFrame([], source.schema).write.parquet(f"{root}/{SIDE}={name}")

    archived = seen.get["n_rows_archive"]
    counters.add_rows("select", archived + seen.get["n_rows_keep"])
    counters.add_rows("delete", archived, calls=1)


def _keeps_only(spec: ArchiveSpec) -> bool:
    """Does nobody ask for the archived rows themselves?"""
    return spec.purge and spec.hooks.before_delete is None


def _archived(spark: SparkSession, source: DataFrame, spec: ArchiveSpec, journal: Journal) -> DataFrame | None:
    if spec.no_delete:
        return spark.read.schema(_chosen(source, spec).schema).parquet(journal.folder("copied"))
    if _keeps_only(spec):
        return None
    return spark.read.schema(source.schema).parquet(f"{journal.folder('split')}/{SIDE}=archive")


def _spare(archived: DataFrame, spec: ArchiveSpec, counters: Counters, journal: Journal, scratch: Scratch) -> None:
    """Ask the before_delete hook which rows to delete; write these, and those it spares.

    One count per distinct row tells both: below zero, the hook added the row; above zero,
    it spared that many copies.
    """
    columns = archived.columns
    chosen = journal.fresh("chosen")
    archived.transform(spec.hooks.before_delete).select(*columns).write.parquet(chosen)
    chosen = archived.sparkSession.read.schema(archived.schema).parquet(chosen)
    signed = archived.withColumn("_n", F.lit(1).cast("long")).unionByName(
        chosen.withColumn("_n", F.lit(-1).cast("long"))
    )
    counts = scratch.stage(signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0"), "spared")
    if not counts.where("_n < 0").isEmpty():
        raise ValueError("a before_delete hook may only remove rows from the set")
    one = F.lit(1).cast("long")
    multiply(counts, one, F.col("_n"), "_copy").select(*columns).write.parquet(journal.fresh("spared"))
    counters.add_rows("delete", -(counts.agg(F.sum("_n").alias("n")).first()["n"] or 0))


def _publish(spark: SparkSession, spec: ArchiveSpec, counters: Counters, journal: Journal) -> str:
    """The kept rows as plain files in exactly ``kept_path``."""
    path = spec.kept_path.rstrip("/")
    keep = f"{journal.folder('split')}/{SIDE}=keep"
    if journal.facts(_PUBLISHING) is not None and path_exists(spark, path):
        return path  # an earlier run came as far as this
    move_files(spark, journal.folder("spared"), keep, "spared-")
    if "s" in (spec.optimize or ""):
        with counters.timed("optimize"):
            tidy = journal.fresh("tidy")
            compact(spark, keep, tidy, keys=spec.keys)
            keep = tidy
    journal.once(_PUBLISHING, dict)
    move_path(spark, keep, path)
    return path


# formats whose tables are no more than their files
_FILES = ("parquet", "orc", "json", "csv", "avro", "text")


def _prepare(
    rows: DataFrame, dest: DataFrame | None, spec: ArchiveSpec, counters: Counters, journal: Journal, scratch: Scratch
) -> dict:
    """Settle which rows the destination gets, and write them down, checked, beside it."""
    spark, target = rows.sparkSession, spec.dest
    with counters.timed("insert"):
        if spec.bulk_insert:
            path = scratch.path("bulk")
            export_dump(rows, path)
            rows = scratch.stage(import_dump(spark, path, rows.schema), "loaded")
        if dest is not None:
            rows = rows.select(*common_columns(dest, rows.columns))
            missing = [f for f in dest.schema.fields if f.name not in rows.columns]
            rows = rows.select(
                "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
            ).select(*dest.columns)

        if spec.replace:
            rows = scratch.stage(settle(rows, [list(spec.keys)], (), last=True), "settled")
        if spec.replace and dest is not None:
            if not target.path:
                raise ValueError("replace rewrites the destination and needs one given by path")
            path = _beside(journal, "replaced")
            drop_path(spark, path)
            _write_checked(replace_into(dest, rows, list(spec.keys)), replace(target, path=path), spec.verify)
            return {"dest_path": path, "n_rows": rows.count(), "how": "replaced"}
        left_out = None
        if spec.keys and spec.unique_keys and (dest is not None or spec.ignore):
            fresh = scratch.stage(new_rows(rows.limit(0) if dest is None else dest, rows, list(spec.keys)), "fresh")
            left_out = rows.count() - fresh.count()
            if not spec.ignore and left_out:
                raise ValueError("rows conflict with the destination's keys; use ignore or replace")
            rows = fresh
        if spec.ignore and left_out is not None:
            counters.add_rows("ignored", left_out)
        if target.path and target.format in _FILES:
            incoming = _beside(journal, "incoming")
            drop_path(spark, incoming)
            sent = _write_checked(rows, replace(target, path=incoming), spec.verify)
            return {"dest_path": target.path, "n_rows": sent, "how": "files"}
        rows.write.parquet(journal.fresh("outgoing"))
        had = dest.count() if dest is not None else 0
        return {"dest_path": target.path, "n_rows": _read_outgoing(spark, journal).count(), "how": "rows", "had": had}


def _read_outgoing(spark: SparkSession, journal: Journal) -> DataFrame:
    return spark.read.parquet(journal.folder("outgoing"))


def _insert(sent: Mapping, spec: ArchiveSpec, counters: Counters, journal: Journal) -> None:
    """Bring the prepared rows to the destination; run again, it brings what is not there yet."""
    spark, target = journal.spark, spec.dest
    with counters.timed("insert"):
        if sent["how"] == "files":
            incoming = _beside(journal, "incoming")
            move_files(spark, incoming, target.path, f"{journal.facts('begun')['id']}-")
            drop_path(spark, incoming)
        elif sent["how"] == "rows":
            _insert_rows(_read_outgoing(spark, journal), sent["had"], sent["n_rows"], target, journal)
    counters.entries["insert"][0] -= 1  # counted when the rows were prepared
    counters.add_rows("insert", sent["n_rows"])


def _insert_rows(rows: DataFrame, had: int, n_rows: int, target: SourceSpec, journal: Journal) -> None:
    """Add rows to a table that only takes rows, which tells by its size what it has got.

    Nobody else may write to it meanwhile.
    """
    spark = journal.spark

    def size() -> int:
        table = _existing(spark, target)
        return table.count() if table is not None else 0

    if journal.facts("inserting") is None or size() == had:
        journal.once("inserting", dict)
        _write(rows, target)
    if (has := size()) - had != n_rows:
        raise RuntimeError(f"the destination got {has - had} rows instead of {n_rows}")


def _sums(columns: Sequence[str], verify: bool) -> list[Column]:
    """The number of rows and, to verify, the sums of checksum pieces."""
    pieces = row_pieces(list(columns)) if verify else ()
    return [F.count(F.lit(1)).alias("n_rows"), *(F.sum(p).alias(f"sum{i}") for i, p in enumerate(pieces))]


def _require_arrived(there: DataFrame, sent: Mapping[str, object], verify: bool) -> None:
    found = there.agg(*_sums(there.columns, verify)).first().asDict()
    if found != dict(sent):
        raise RuntimeError(f"the destination does not hold the rows sent: {found} instead of {dict(sent)}")


def _write_checked(rows: DataFrame, target: SourceSpec, verify: bool) -> int:
    """Write a folder of its own and look there for the rows; their number."""
    seen = Observation()
    _write(rows.observe(seen, *_sums(rows.columns, verify)), target)
    there = read_source(rows.sparkSession, target)
    if target.format not in ("parquet", "orc", "avro"):  # texts, which name no types
        there = rows.sparkSession.read.format(target.format).options(**target.options).schema(rows.schema).load(target.path)
    _require_arrived(there.select(*rows.columns), seen.get, verify)
    return seen.get["n_rows"]


def _write(rows: DataFrame, target: SourceSpec) -> None:
    if target.url:
        rows.write.mode("append").format("jdbc").options(**jdbc_options(target)).save()
    elif target.path:
        rows.write.mode("append").format(target.format).options(**target.options).save(target.path)
    else:
        rows.write.mode("append").saveAsTable(f"{target.database}.{target.table}")


def _write_files(
    rows: DataFrame, columns: Sequence[str], spec: ArchiveSpec, counters: Counters, journal: Journal
) -> dict:
    """Archive files of some columns by the template, checked by their number of lines.

    The place must be free; what an unfinished run of this job wrote there is replaced.
    """
    at = dt.datetime.fromisoformat(journal.facts("begun")["at"])
    names = (spec.source.database, spec.source.table)
    path = render_name(spec.file, at, *names) if spec.file_ts is None else fixed_folder(spec.file)
    if journal.facts("filing") is not None:
        drop_path(rows.sparkSession, path)
    elif path_exists(rows.sparkSession, path):
        raise ValueError(f"{path} already exists")
    journal.once("filing", dict)
    with counters.timed("file"):
        _lines_to_files(rows, columns, spec, path)
    counters.add_rows("file", rows.count())
    return {"path": path}


def _lines_to_files(rows: DataFrame, columns: Sequence[str], spec: ArchiveSpec, path: str) -> None:
    schema = rows.select(*columns).schema
    names = (spec.source.database, spec.source.table)
    csv = spec.output_format == "csv"
    line = csv_line if csv else dump_line
    # a record has as many lines as its text has line feeds, and one
    breaks = F.length("line") - F.length(F.replace("line", F.lit("\n"), F.lit(""))) + 1
    seen = Observation()
    if spec.file_ts is None:
        lines = rows.select(line(schema).alias("line")).observe(seen, F.sum(breaks).alias("n"))
        write_lines(lines, path, header_line(schema.names, csv) if spec.header else None)
        _require_lines(rows.sparkSession, path, seen, spec.header)
        return
    # a column per folder level of the template, from the first one with a code
    levels = spec.file[len(path) :].strip("/").split("/")
    folders = [f"archive_{i}" for i in range(len(levels) - 1)] + ["archive_file"]
    routed = rows.select(
        line(schema).alias("line"),
        *(archive_name(F.col(spec.file_ts), t, *names).alias(c) for t, c in zip(levels, folders)),
    ).observe(seen, F.sum(breaks).alias("n"))
    routed = routed.hint("rebalance", *[F.col(c) for c in folders])
    if spec.header:
        # a file begins where a task's rows, sorted by file, come to another one
        header = header_line(schema.names, csv)
        placed = routed.sortWithinPartitions(*folders).withColumn("_at", F.monotonically_increasing_id())
        same_file = W.partitionBy(F.shiftright("_at", 33), *folders).orderBy("_at")
        first = F.row_number().over(same_file) == 1
        text = F.when(first, F.concat(F.lit(header + "\n"), F.col("line"))).otherwise(F.col("line"))
        routed = placed.withColumn("line", text).drop("_at")
    routed.write.partitionBy(*folders).option("maxRecordsPerFile", 0).text(path)
    _require_lines(rows.sparkSession, path, seen, spec.header)


def _require_lines(spark: SparkSession, path: str, seen: Observation, header: bool) -> None:
    read = spark.read.option("lineSep", "\n").text(path).select(F.input_file_name().alias("file"))
    found = read.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("file").alias("files")).first()
    expected = (seen.get["n"] or 0) + (found["files"] if header else 0)
    if found["n"] != expected:
        raise RuntimeError(f"the files hold {found['n']} lines instead of {expected}")


def _optimize_dest(spark: SparkSession, spec: ArchiveSpec, path: str, counters: Counters, journal: Journal) -> dict:
    """Compact the destination into a folder of its own, which the result names.

    The folder it had before stays as it is, for readers that still use it.
    """
    with counters.timed("optimize"):
        tidy = _beside(journal, "compact")
        drop_path(spark, tidy)
        compact(spark, path, tidy, keys=spec.keys, format=spec.dest.format)
    return {"path": tidy}


def _analyze(spark: SparkSession, spec: ArchiveSpec, result: ArchiveResult) -> None:
    for place in spec.analyze or "":
        if place == "s" and result.kept_path:
            result.analysis[place] = analyze_columns(spark.read.parquet(result.kept_path), exact_distinct=False)
        elif place == "d" and result.dest_path:
            table = read_source(spark, replace(spec.dest, path=result.dest_path))
            result.analysis[place] = analyze_columns(table, exact_distinct=False)
        elif place == "d" and spec.dest and not spec.dest.url:
            analyze_table(read_source(spark, spec.dest), f"{spec.dest.database}.{spec.dest.table}")
