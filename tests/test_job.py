import random
from collections import Counter
from dataclasses import replace
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from coldshelf.operators.stats import analyze_columns, counter_deltas, keep_latest_autoinc, table_status
from coldshelf.plans.job import drop_job, run_archive
from coldshelf.plans.spec import ArchiveSpec, Hooks
from coldshelf.plans.staging import workspace
from coldshelf.sources.endpoints import SourceSpec
from coldshelf.streaming.archive_stream import archive_stream, keyed_batch


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def job(spark, folder):
    spark.range(100).selectExpr("id", "nullif(id % 4, 3) AS v", "CAST(id AS string) AS s").repartition(3).write.parquet(
        f"{folder}/src"
    )
    return ArchiveSpec(
        source=SourceSpec("db", "t", path=f"{folder}/src"),
        where="v < 2",
        dest=SourceSpec(path=f"{folder}/dest"),
        kept_path=f"{folder}/kept",
        keys=("id",),
        chunk_rows=8,
    )


@pytest.mark.parametrize(
    "change",
    [
        {"where": " "}, {"output_format": "xml"}, {"analyze": "x"}, {"optimize": "sd"}, {"chunk_rows": 0},
        {"progress": -1}, {"dest": None, "file": "/f", "bulk_insert": True}, {"purge": True, "no_delete": True},
        {"ignore": True, "replace": True}, {"dest": None}, {"purge": True}, {"replace": True, "keys": ()},
        {"primary_key_only": True, "keys": ()}, {"kept_path": None},
        {"source": SourceSpec(None, "t")}, {"source": SourceSpec("db", None)},
    ],
)
def test_bad_jobs_are_refused(job, change):
    with pytest.raises(ValueError):
        replace(job, **change).validated()


def test_archive_moves_rows(spark, job):
    source = spark.read.parquet(job.source.path)
    result = run_archive(spark, replace(job, progress=20))
    assert [(r.rows_done, r.hi.id) for r in result.progress.orderBy("rows_done").collect()] == [
        (20, 37), (40, 77), (50, 97),
    ]
    dest, kept = spark.read.parquet(result.dest_path), spark.read.parquet(result.kept_path)
    assert bag(dest) + bag(kept) == bag(source)
    assert bag(dest) == bag(source.where("v < 2"))
    manifest = result.manifest.orderBy("chunk_id").collect()
    assert sum(m.n_rows for m in manifest) == 50 and manifest[0].lo.id == 0
    stats = {r.action: (r.calls, r.n_rows) for r in result.statistics.collect()}
    assert stats == {"select": (1, 100), "delete": (1, 50), "insert": (1, 50)}
    assert bag(spark.read.parquet(job.source.path)) == bag(source)
    assert not list(Path(job.kept_path).glob("*=archive"))


def test_kept_rows_are_never_written_over(spark, job):
    run_archive(spark, job)
    with pytest.raises(Exception, match="(?i)already exists"):
        run_archive(spark, replace(job, ignore=True))


def test_second_run_of_plain_insert_is_refused_and_ignore_is_idempotent(spark, job):
    first = run_archive(spark, job)
    again = replace(job, kept_path=f"{job.kept_path}2")
    with pytest.raises(ValueError, match="conflict"):
        run_archive(spark, again)
    result = run_archive(spark, replace(job, kept_path=f"{job.kept_path}3", ignore=True))
    assert spark.read.parquet(first.dest_path).count() == 50
    assert spark.read.parquet(result.kept_path).count() == 50


def test_changing_predicate_loses_no_row(spark, job):
    result = run_archive(spark, replace(job, where="rand() < 0.5"))
    both = spark.read.parquet(result.dest_path).unionByName(spark.read.parquet(result.kept_path))
    assert bag(both) == bag(spark.read.parquet(job.source.path))


@pytest.mark.parametrize("where, archived, verify", [("true", 100, True), ("false", 0, False)])
def test_one_side_may_be_empty(spark, job, where, archived, verify):
    result = run_archive(spark, replace(job, where=where, verify=verify))
    assert spark.read.parquet(result.kept_path).count() == 100 - archived
    assert spark.read.parquet(result.dest_path).count() == archived


def test_predicate_may_look_into_another_table(spark, job):
    spark.createDataFrame([(1,), (2,), (None,)], "k bigint").createOrReplaceTempView("parents")
    orphans = "NOT EXISTS (SELECT * FROM parents WHERE parents.k = t.v)"
    result = run_archive(spark, replace(job, where=orphans))
    assert {r.v for r in spark.read.parquet(result.kept_path).collect()} == {1, 2}
    assert {r.v for r in spark.read.parquet(result.dest_path).collect()} == {0, None}


def test_dry_run_writes_nothing(spark, job):
    result = run_archive(spark, replace(job, dry_run=True))
    assert "== Physical Plan ==" in result.plan and "split by: v < 2" in result.steps
    assert not Path(job.kept_path).exists() and not Path(job.dest.path).exists()


def test_columns_must_agree_with_the_destination(spark, job):
    spark.createDataFrame([(1, "x")], "id int, extra string").write.parquet(job.dest.path)
    with pytest.raises(ValueError, match="extra"):
        run_archive(spark, job)
    result = run_archive(
        spark, replace(job, check_columns=False, columns=("id", "s"), keys=(), unique_keys=False)
    )
    rows = spark.read.parquet(result.dest_path)
    assert rows.where("extra IS NULL").count() == 50


def test_columns_of_the_destination_may_be_in_another_order(spark, job):
    spark.createDataFrame([("x", 7, 999)], "s string, v bigint, id bigint").write.parquet(job.dest.path)
    rows = spark.read.parquet(run_archive(spark, job).dest_path)
    assert rows.columns == ["s", "v", "id"] and rows.where("s = CAST(id AS string)").count() == 50


def test_replace_writes_a_new_destination(spark, job):
    spark.createDataFrame([(1, 9, "old"), (999, 9, "old")], "id bigint, v bigint, s string").write.parquet(job.dest.path)
    result = run_archive(spark, replace(job, replace=True))
    assert result.dest_path != job.dest.path
    rows = {r.id: r.s for r in spark.read.parquet(result.dest_path).collect()}
    assert rows[999] == "old" and rows[1] == "1" and len(rows) == 51


def test_saved_table_as_destination(spark, job):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf_db")
    spark.sql("DROP TABLE IF EXISTS shelf_db.old_rows")
    dest = SourceSpec("shelf_db", "old_rows")
    run_archive(spark, replace(job, dest=dest, analyze="d"))
    assert spark.table("shelf_db.old_rows").count() == 50
    facts = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED shelf_db.old_rows").collect()}
    assert "50 rows" in facts["Statistics"]
    spark.sql("DROP DATABASE shelf_db CASCADE")


def test_safe_auto_increment(spark, job):
    result = run_archive(spark, replace(job, where="true", autoinc_col="id"))
    assert [r.id for r in spark.read.parquet(result.kept_path).collect()] == [99]
    df = spark.read.parquet(job.source.path)
    assert keep_latest_autoinc(df, "id", df, enabled=False).count() == 100


def test_hooks(spark, job):
    seen = []
    hooks = Hooks(
        before_insert=lambda df: df.withColumn("s", F.lit("***")),
        before_delete=lambda df: df.where("id >= 10"),
        after_finish=lambda stats: seen.append(stats.count()),
    )
    result = run_archive(spark, replace(job, hooks=hooks))
    assert {r.s for r in spark.read.parquet(result.dest_path).collect()} == {"***"}
    assert spark.read.parquet(result.kept_path).where("id < 10").count() == 10
    stats = {r.action: r.n_rows for r in result.statistics.collect()}
    assert stats["delete"] == 50 - 6 and seen == [3]
    adding = Hooks(before_delete=lambda df: df.unionByName(df.limit(1)))
    with pytest.raises(ValueError, match="only remove"):
        run_archive(spark, replace(job, hooks=adding, ignore=True, kept_path=f"{job.kept_path}2"))


def test_upkeep(spark, job):
    result = run_archive(spark, replace(job, optimize="ds", analyze="ds"))
    assert set(result.analysis) == {"d", "s"}
    assert bag(spark.read.parquet(result.dest_path)) == bag(spark.read.parquet(job.source.path).where("v < 2"))
    row = result.analysis["s"].where("column = 'v'").first()
    assert (row.n_rows, row.n_nulls, row.n_distinct, row.min_value) == (50, 25, 1, "2")


def test_stream_equals_batch(spark, folder):
    df = spark.range(1000).selectExpr("id", "nullif(id % 5, 2) AS v")
    df.repartition(7).write.parquet(f"{folder}/in")
    args = (spark, f"{folder}/in", df.schema, "v < 3", f"{folder}/out", f"{folder}/state")
    archived, kept = archive_stream(*args, per_batch=2)
    assert bag(archived) == bag(df.where("v < 3"))
    assert bag(archived) + bag(kept) == bag(df)
    more = spark.range(1000, 1100).selectExpr("id", "id % 5 AS v")
    more.write.mode("append").parquet(f"{folder}/in")
    archived, kept = archive_stream(*args, per_batch=2)
    assert bag(archived) + bag(kept) == bag(df) + bag(more)
    archived, _ = archive_stream(*args, sleep="1 second", max_run=2)
    assert archived.count() == df.where("v < 3").count() + 60
    with pytest.raises(ValueError):
        archive_stream(*args, sleep="1 second")


def keyed(spark, folder, rows, number, replace=False, order_by=("n",)):
    """Batch ``number`` of a keyed stream, by hand."""
    run = keyed_batch("n >= 0", f"{folder}/dest", f"{folder}/kept", ["k"], f"{folder}/notes", replace, list(order_by))
    run(spark.createDataFrame(rows, "k int, n int, s string"), number)
    return Counter(tuple(r) for r in spark.read.parquet(f"{folder}/dest").collect())


@pytest.mark.parametrize("replace", [False, True])
def test_a_batch_that_is_run_again_adds_nothing(spark, folder, replace):
    first = [(1, 5, "a"), (1, 3, "b"), (None, 1, "null"), (2, -1, "kept")]
    second = [(1, 9, "c"), (3, 1, "d"), (None, 2, "null too"), (4, -7, "kept too")]
    for _ in range(2):
        one = keyed(spark, folder, first, 0, replace)
    assert one == Counter([(1, 5, "a") if replace else (1, 3, "b"), (None, 1, "null")])
    for _ in range(2):
        two = keyed(spark, folder, second, 1, replace)
    mine = (1, 9, "c") if replace else (1, 3, "b")
    assert two == Counter([mine, (None, 1, "null"), (3, 1, "d"), (None, 2, "null too")])
    assert sorted(r.s for r in spark.read.parquet(f"{folder}/kept").collect()) == ["kept", "kept too"]


@pytest.mark.parametrize("step", ["delete_rows_in_files", "move_files"])
def test_a_batch_may_break_off(spark, folder, monkeypatch, step):
    from coldshelf.streaming import archive_stream as module

    keyed(spark, folder, [(1, 1, "old"), (2, 1, "old")], 0, True)
    work = getattr(module, step)

    def broken(*args):
        work(*args)
        raise OSError("the driver is lost")

    monkeypatch.setattr(module, step, broken)
    rows = [(2, 2, "new"), (3, 2, "new"), (9, -1, "kept")]
    with pytest.raises(OSError):
        keyed(spark, folder, rows, 1, True)
    monkeypatch.undo()
    assert keyed(spark, folder, rows, 1, True) == Counter([(1, 1, "old"), (2, 2, "new"), (3, 2, "new")])
    assert spark.read.parquet(f"{folder}/kept").count() == 1


def test_table_status_and_columns(spark):
    df = spark.createDataFrame([(1, "ab", None), (2, None, 1.5), (3, "é", 2.5)], "id bigint, t string, d double")
    row = table_status(df, "x", autoinc_col="id", checksum=True).first()
    assert (row.n_rows, row.data_length, row.avg_row_length, row.auto_increment) == (3, 44, 14, 4)
    assert row.last_update is None and row.checksum is not None
    empty = table_status(df.limit(0), "x").first()
    assert (empty.n_rows, empty.avg_row_length, empty.data_length) == (0, None, 0)
    exact = {r.column: tuple(r)[1:] for r in analyze_columns(df).collect()}
    assert exact["t"] == (3, 1, 2, "ab", "é") and exact["d"] == (3, 1, 2, "1.5", "2.5")
    assert {r.column: tuple(r)[1:] for r in analyze_columns(df, exact_distinct=False).collect()} == exact


@pytest.mark.parametrize("max_group", [1, 20, 1000])
def test_counter_deltas_across_spans(spark, max_group):
    rng = random.Random(8)
    rows = []
    for device in ("hot", "a", None):
        at = -500.0
        for _ in range(400 if device == "hot" else 9):
            at += rng.choice([0.5, 1.25, 30, 4000])
            rows.append((device, at, rng.randrange(100)))
    df = spark.createDataFrame(rows, "dev string, at double, n bigint").selectExpr(
        "dev", "timestamp_micros(CAST(at * 1000000 AS bigint)) AS at", "n"
    )
    found = {(r.dev, r["at"]): (r.n_delta, r.n_rate) for r in counter_deltas(df, ["dev"], "at", ["n"], max_group).collect()}
    expected, last = {}, {}
    for (device, at, n), stamp in zip(rows, [r["at"] for r in df.collect()]):
        prev = last.get(device)
        delta = n - prev[1] if prev and n >= prev[1] else None
        expected[device, stamp] = (delta, None if delta is None else pytest.approx(delta / (at - prev[0])))
        last[device] = (at, n)
    assert found == expected


def test_workspace_is_the_clusters_folder(spark):
    def session(folder, master):
        return SimpleNamespace(
            conf={"spark.checkpoint.dir": folder} if folder else {},
            sparkContext=SimpleNamespace(master=master, applicationId="app"),
        )

    assert workspace(session("hdfs://shared/ck/", "yarn")) == "hdfs://shared/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(session(None, "yarn"))
    assert workspace(spark) == workspace(spark)


def test_a_job_clears_its_scratch(spark, job):
    before = set(Path(workspace(spark)).glob("*"))
    run_archive(spark, replace(job, keys=(), unique_keys=False, bulk_insert=True))
    left = {p.name.split("-")[0] for p in set(Path(workspace(spark)).glob("*")) - before}
    assert left <= {"records"}  # the staged records of the import


# -- a job that is run again, goes wrong or is given odd places -----------------------


def test_ignore_and_replace_need_unique_keys(job):
    for change in ({"ignore": True}, {"replace": True}):
        with pytest.raises(ValueError, match="unique"):
            replace(job, unique_keys=False, **change).validated()


def test_kept_path_holds_the_kept_rows_and_nothing_else(spark, job, folder):
    source = spark.read.parquet(job.source.path)
    for optimize in (None, "s", "ds"):
        spec = replace(job, optimize=optimize, kept_path=f"{folder}/kept-{optimize}", dest=SourceSpec(path=f"{folder}/d-{optimize}"))
        result = run_archive(spark, spec)
        assert result.kept_path == spec.kept_path
        kept = spark.read.parquet(spec.kept_path)
        assert kept.columns == source.columns
        assert bag(kept) == bag(source.where("NOT v < 2 OR v IS NULL"))
        assert bag(spark.read.parquet(result.dest_path)) == bag(source.where("v < 2"))
    assert not list(Path(folder).glob("*.job-*"))


def test_second_job_on_one_destination(spark, job, folder):
    first = replace(job, optimize="d", ignore=True)
    one = run_archive(spark, first)
    two = run_archive(spark, replace(first, kept_path=f"{folder}/kept2"))
    assert one.dest_path != two.dest_path
    assert spark.read.parquet(two.dest_path).count() == 50
    figures = {r.action: r.n_rows for r in two.statistics.collect()}
    assert figures["ignored"] == 50 and figures["insert"] == 0


@pytest.mark.parametrize("form", ["file:{0}/src", "file://{0}/src/", "{0}//src", "{0}/src/below", "{0}"])
def test_nothing_is_written_into_the_source(spark, job, folder, form):
    place = form.format(folder)
    with pytest.raises(ValueError):
        run_archive(spark, replace(job, dest=SourceSpec(path=place)))
    with pytest.raises(ValueError):
        run_archive(spark, replace(job, kept_path=place))
    assert spark.read.parquet(job.source.path).count() == 100


def test_other_formats(spark, job, folder):
    spec = replace(job, dest=SourceSpec(path=f"{folder}/orc", format="orc"), optimize="ds", analyze="d")
    result = run_archive(spark, spec)
    assert spark.read.orc(result.dest_path).count() == 50
    assert {r["column"]: r.n_rows for r in result.analysis["d"].collect()} == {"id": 50, "v": 50, "s": 50}


def test_failed_job_leaves_no_kept_rows_and_can_be_run_again(spark, job, folder):
    spark.range(5).selectExpr("id", "id AS v", "CAST(id AS string) AS s").write.parquet(f"{folder}/dest")
    with pytest.raises(ValueError, match="conflict"):
        run_archive(spark, job)
    assert not Path(job.kept_path).exists() and not list(Path(folder).glob("*.job-*"))
    run_archive(spark, replace(job, ignore=True))
    assert spark.read.parquet(job.kept_path).count() == 50


def test_replace_settles_rows_of_a_new_destination(spark, job, folder):
    spec = replace(job, keys=("v",), replace=True, check_columns=False)
    assert spark.read.parquet(run_archive(spark, spec).dest_path).count() == 2


@pytest.mark.parametrize("change", [{}, {"verify": False}, {"replace": True}])
def test_a_row_lost_on_its_way_fails_the_job(spark, job, folder, monkeypatch, change):
    from coldshelf.plans import job as module

    if "replace" in change:
        spark.range(3).selectExpr("id", "id AS v", "CAST(id AS string) AS s").write.parquet(f"{folder}/dest")
        read = module.read_source
        monkeypatch.setattr(
            module, "read_source",
            lambda s, spec: read(s, spec).where("id <> 4") if spec.path and ".replaced-" in spec.path else read(s, spec),
        )
    else:
        write = module._write
        monkeypatch.setattr(module, "_write", lambda rows, target: write(rows.where("id <> 4"), target))
    with pytest.raises(RuntimeError, match="destination"):
        run_archive(spark, replace(job, **change))
    assert not Path(job.kept_path).exists()


def test_a_line_lost_on_its_way_fails_the_job(spark, job, folder, monkeypatch):
    from coldshelf.plans import job as module

    write = module.write_lines
    monkeypatch.setattr(module, "write_lines", lambda lines, *a: write(lines.where("line NOT LIKE '4%'"), *a))
    with pytest.raises(RuntimeError, match="lines"):
        run_archive(spark, replace(job, dest=None, file=f"{folder}/files/x"))


def test_copy_job_reads_only_what_it_needs(spark, job, folder):
    spec = replace(job, no_delete=True, kept_path=None, columns=("id", "v"), dry_run=True)
    plan = run_archive(spark, spec).plan
    assert "LessThan(v,2)" in plan.split("PushedFilters")[1].split("\n")[0]
    assert "ReadSchema: struct<id:bigint,v:bigint>" in plan
    result = run_archive(spark, replace(spec, dry_run=False))
    assert spark.read.parquet(result.dest_path).columns == ["id", "v"]


def test_headers_and_folders_by_row_time(spark, folder):
    rows = spark.range(60).selectExpr("id", "CAST(DATE '2020-01-01' + CAST(id * 20 AS int) AS timestamp_ntz) AS at")
    rows.write.parquet(f"{folder}/src")
    spec = ArchiveSpec(
        source=SourceSpec("db", "t", path=f"{folder}/src"), where="id >= 0", no_delete=True,
        file=f"{folder}/out/%Y/%t-%m", file_ts="at", header=True,
    )
    run_archive(spark, spec)
    files = list(Path(f"{folder}/out").rglob("part-*"))
    assert files and all(f.read_text().startswith("id\tat\n") for f in files)
    assert {f.parent.parent.name.split("=")[-1] for f in files} == {"2020", "2021", "2022", "2023"}
    assert sum(len(f.read_text().splitlines()) - 1 for f in files) == 60


# -- jobs that break off and are run again --------------------------------------------


@pytest.fixture
def plain(job):
    """Without keys nothing but the journal keeps rows from being inserted twice."""
    return replace(job, keys=(), unique_keys=False)


def test_a_job_that_fails_after_the_insert_goes_on_behind_it(spark, plain, folder):
    spec = replace(plain, file=f"{folder}/files")
    Path(f"{folder}/files").mkdir()
    with pytest.raises(ValueError, match="exists"):
        run_archive(spark, spec)
    assert spark.read.parquet(spec.dest.path).count() == 50 and not Path(spec.kept_path).exists()
    spark.range(3).selectExpr("id", "0L AS v", "'late' AS s").write.mode("append").parquet(spec.source.path)
    Path(f"{folder}/files").rmdir()
    result = run_archive(spark, spec)
    source = spark.read.parquet(spec.source.path).where("s <> 'late'")
    assert bag(spark.read.parquet(spec.dest.path)) + bag(spark.read.parquet(spec.kept_path)) == bag(source)
    figures = {r.action: (r.calls, r.n_rows) for r in result.statistics.collect()}
    assert figures == {"select": (1, 100), "delete": (1, 50), "insert": (1, 50), "file": (1, 50)}
    assert not Path(f"{spec.kept_path}.journal").exists() and not list(Path(folder).glob("dest.*"))


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_files_that_have_arrived_do_not_arrive_again(spark, plain, folder, monkeypatch, moved):
    from coldshelf.plans import job as module

    move = module.move_files

    def broken(spark, source, into, prefix):
        for name in sorted(p.name for p in Path(source).glob("part-*"))[:moved]:
            Path(into).mkdir(exist_ok=True)
            (Path(source) / name).rename(Path(into) / (prefix + name))
        raise OSError("the driver is lost")

    monkeypatch.setattr(module, "move_files", broken)
    with pytest.raises(OSError):
        run_archive(spark, plain)
    monkeypatch.setattr(module, "move_files", move)
    run_archive(spark, plain)
    assert bag(spark.read.parquet(plain.dest.path)) == bag(spark.read.parquet(plain.source.path).where("v < 2"))


@pytest.mark.parametrize(
    "step, when",
    [(s, "after") for s in ("_split", "_spare", "_prepare", "_insert", "_write_files", "_optimize_dest", "_publish")]
    + [(s, "before") for s in ("_prepare", "_insert", "_publish")],
)
def test_a_job_may_break_off_anywhere(spark, plain, folder, monkeypatch, step, when):
    from coldshelf.plans import job as module

    spec = replace(plain, file=f"{folder}/files", optimize="d", hooks=Hooks(before_delete=lambda df: df.where("id > 9")))
    work = getattr(module, step)

    def broken(*args):
        if when == "after":
            work(*args)
        raise OSError("the driver is lost")

    # a lost driver clears nothing away
    monkeypatch.setattr(module, step, broken)
    monkeypatch.setattr(module, "_discard", lambda journal: None)
    with pytest.raises(OSError):
        run_archive(spark, spec)
    monkeypatch.undo()
    result = run_archive(spark, spec)
    source = spark.read.parquet(spec.source.path)
    gone = bag(source.where("v < 2 AND id > 9"))
    assert bag(spark.read.parquet(spec.dest.path)) == gone and bag(spark.read.parquet(result.dest_path)) == gone
    assert gone + bag(spark.read.parquet(spec.kept_path)) == bag(source)
    assert spark.read.text(f"{folder}/files").count() == sum(gone.values())
    assert not Path(f"{spec.kept_path}.journal").exists()


def test_a_hook_that_fails_once_costs_nothing(spark, plain):
    failing = replace(plain, hooks=Hooks(before_delete=lambda df: df.where("no_such_column > 1")))
    with pytest.raises(Exception, match="no_such_column"):
        run_archive(spark, failing)
    assert not Path(plain.dest.path).exists() and not Path(f"{plain.kept_path}.journal").exists()
    run_archive(spark, plain)
    assert spark.read.parquet(plain.dest.path).count() == 50


def test_spared_rows_are_kept_and_not_copied(spark, plain):
    source = spark.read.parquet(plain.source.path)
    hooks = Hooks(before_delete=lambda df: df.where("id >= 10"))
    for spec in (replace(plain, hooks=hooks), replace(plain, dest=None, purge=True, kept_path=f"{plain.kept_path}2", hooks=hooks)):
        result = run_archive(spark, spec)
        assert bag(spark.read.parquet(spec.kept_path)) == bag(source.where("NOT v < 2 OR v IS NULL OR id < 10"))
        assert {r.action: r.n_rows for r in result.statistics.collect()}["delete"] == 44
    assert bag(spark.read.parquet(plain.dest.path)) == bag(source.where("v < 2 AND id >= 10"))


def test_another_job_may_not_take_over_a_journal(spark, plain, folder):
    spec = replace(plain, file=f"{folder}/files")
    Path(f"{folder}/files").mkdir()
    with pytest.raises(ValueError, match="exists"):
        run_archive(spark, spec)
    with pytest.raises(ValueError, match="broke off"):
        run_archive(spark, plain)
    drop_job(spark, f"{plain.kept_path}.journal")
    assert not list(Path(folder).glob("*.journal")) and not list(Path(folder).glob("dest.*"))


def test_a_table_that_only_takes_rows_gets_them_once(spark, plain, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf_db")
    spark.sql("DROP TABLE IF EXISTS shelf_db.rows_once")
    spec = replace(plain, dest=SourceSpec("shelf_db", "rows_once"), file=f"{folder}/files")
    Path(f"{folder}/files").mkdir()
    with pytest.raises(ValueError, match="exists"):
        run_archive(spark, spec)
    Path(f"{folder}/files").rmdir()
    run_archive(spark, spec)
    assert spark.table("shelf_db.rows_once").count() == 50
    spark.sql("DROP DATABASE shelf_db CASCADE")


@pytest.mark.parametrize("wrote", [False, True])
def test_a_table_whose_insert_broke_off(spark, plain, folder, monkeypatch, wrote):
    from coldshelf.plans import job as module

    spark.sql("CREATE DATABASE IF NOT EXISTS shelf_db")
    spark.sql("DROP TABLE IF EXISTS shelf_db.rows_once")
    spark.sql("CREATE TABLE shelf_db.rows_once AS SELECT 999L AS id, 0L AS v, 'x' AS s")
    write = module._write

    def broken(rows, target):
        if wrote:
            write(rows, target)
        raise OSError("the driver is lost")

    monkeypatch.setattr(module, "_write", broken)
    spec = replace(plain, dest=SourceSpec("shelf_db", "rows_once"))
    with pytest.raises(OSError):
        run_archive(spark, spec)
    monkeypatch.undo()
    run_archive(spark, spec)
    assert spark.table("shelf_db.rows_once").count() == 51
    spark.sql("DROP DATABASE shelf_db CASCADE")


def test_a_copy_job_may_have_a_journal(spark, plain, folder):
    spec = replace(plain, no_delete=True, kept_path=None, journal=f"{folder}/notes", file=f"{folder}/files")
    Path(f"{folder}/files").mkdir()
    with pytest.raises(ValueError, match="exists"):
        run_archive(spark, spec)
    Path(f"{folder}/files").rmdir()
    run_archive(spark, spec)
    assert spark.read.parquet(spec.dest.path).count() == 50 and not Path(f"{folder}/notes").exists()


# -- results that do not hang on sizes ------------------------------------------------


@pytest.mark.parametrize("max_group", [1, 2, 7, 1000])
def test_counter_deltas_for_every_group_size(spark, max_group):
    r = random.Random(3)
    rows = [("a", None, 5), ("a", "2020-01-01 00:00:00", 10), ("a", "2020-01-01 00:00:10", 30), ("b", None, 1)]
    rows += [("c", f"2020-01-02 00:{m:02d}:00", r.randrange(100)) for m in range(40)] + [("c", "1990-01-01 00:00:00", 7)] * 3
    frame = spark.createDataFrame(rows, "dev string, at string, hits bigint").selectExpr("dev", "CAST(at AS timestamp_ntz) AS at", "hits")
    expected = bag(counter_deltas(frame, ["dev"], "at", ["hits"]))
    assert bag(counter_deltas(frame, ["dev"], "at", ["hits"], max_group=max_group)) == expected
    first = [r for r in expected if r[0] == "a" and r[2] == 10]
    assert first[0][3] == 5 and first[0][4] is None


def test_lists_in_parts_explode_to_the_whole_list(spark):
    from coldshelf.functions.lists import explode_serialized, group_serialize

    rows = [("g", i, "x" * (i % 50) + ",\\") for i in range(200)] + [("h", 1, ""), ("n", 1, None)]
    frame = spark.createDataFrame(rows, "g string, i bigint, t string")
    whole = bag(explode_serialized(group_serialize(frame, ["g"], "t", ["i"]).drop("part", "n_items"), "items", first_pos="first_pos"))
    assert len(whole) == 202
    for limits in ({"max_items": 7}, {"max_bytes": 300}, {"max_items": 3, "max_bytes": 1}):
        parts = group_serialize(frame, ["g"], "t", ["i"], **limits)
        assert parts.count() > 3
        assert parts.where(F.octet_length("items") > limits.get("max_bytes", 10**9)).where("n_items > 1").isEmpty()
        assert bag(explode_serialized(parts.drop("part", "n_items"), "items", first_pos="first_pos")) == whole


def test_scope_removes_staged_tables(spark, folder):
    from coldshelf.functions.lists import group_serialize
    from coldshelf.operators.chunks import assign_chunks
    from coldshelf.operators.merge import delete_rows_exact
    from coldshelf.plans.staging import staging_scope
    from coldshelf.sources.dump import export_dump, import_dump

    frame = spark.range(50).selectExpr("id", "id % 3 AS g", "'a\\nb' AS t", "CAST('2020-01-01' AS timestamp_ntz) AS at")
    root = workspace(spark).removeprefix("file:")
    before = set(Path(root).iterdir())
    with staging_scope(spark):
        assign_chunks(frame, ["g"], 7).collect()
        group_serialize(frame, ["g"], "t", ["id"], max_items=5).collect()
        counter_deltas(frame, ["g"], "at", ["id"], max_group=5).collect()
        delete_rows_exact(frame, frame.limit(3)).collect()
        export_dump(frame.select("id", "t"), f"{folder}/dump")
        import_dump(spark, f"{folder}/dump", "id bigint, t string").collect()
        assert set(Path(root).iterdir()) != before
    assert set(Path(root).iterdir()) == before
