"""Files in and out, whole jobs, streams and upkeep."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from coldshelf.operators.compact import compact, compact_small
from coldshelf.plans.job import run_archive
from coldshelf.plans.spec import ArchiveSpec, Hooks
from coldshelf.plans.staging import drop_path, new_path
from coldshelf.sources import dump, statements, templates
from coldshelf.sources.endpoints import SourceSpec
from coldshelf.streaming.archive_stream import archive_stream, start_keyed_stream
from suite.common import Suite, table

suite = Suite()

# Texts with every special character: line feeds are in the data, tabs, backslashes and
# NULLs are put in alike by both engines.
_DOC = """doc_id, CASE WHEN doc_id % 11 = 3 THEN NULL
    ELSE replace(replace(text, ' the ', {tab}), 'e,', {slash}) END AS text, lang, n_chars"""
_DUCK_DOC = _DOC.format(tab="chr(9)", slash="'\\N\\'")
_SPARK_DOC = _DOC.format(tab="char(9)", slash="'\\\\N\\\\'")


def _docs(spark, sf):
    return table(spark, sf, "documents").selectExpr(*_split(_SPARK_DOC))


def _split(text: str) -> list[str]:
    first, rest = text.split(",", 1)
    case, lang, n_chars = rest.rsplit(",", 2)
    return [first, case, lang, n_chars]


@suite.add(
    "dump_lines",
    f"""SELECT concat_ws(chr(9), CAST(doc_id AS VARCHAR),
          coalesce(replace(replace(replace(text, '\\', '\\\\'), chr(9), '\\' || chr(9)), chr(10), '\\' || chr(10)), '\\N'),
          lang, CAST(n_chars AS VARCHAR)) AS line
        FROM (SELECT {_DUCK_DOC} FROM documents)""",
)
def dump_lines(spark, sf):
    return dump.dump_lines(_docs(spark, sf))


@suite.add(
    "csv_lines",
    f"""SELECT concat_ws(',', CAST(doc_id AS VARCHAR),
          coalesce('"' || replace(replace(text, '\\', '\\\\'), '"', '\\"') || '"', '\\N'),
          '"' || lang || '"', CAST(n_chars AS VARCHAR)) AS line
        FROM (SELECT {_DUCK_DOC} FROM documents)""",
)
def csv_lines(spark, sf):
    return dump.csv_lines(_docs(spark, sf))


@suite.add("dump_round_trip", f"SELECT {_DUCK_DOC} FROM documents")
def dump_round_trip(spark, sf):
    docs = _docs(spark, sf)
    path = new_path(spark, "dump")
    dump.export_dump(docs.repartition(4, "doc_id"), path, header=True)
    return dump.import_dump(spark, path, docs.schema, header=True)


@suite.add(
    "archive_files",
    """SELECT strftime(o_orderdate, 'shop/%Y-%m-') || 'orders.' || strftime(o_orderdate, '%d') AS archive_file,
              count(*) AS n_rows, min(o_orderkey) AS lo, max(o_orderkey) AS hi
       FROM orders GROUP BY 1""",
)
def archive_files(spark, sf):
    routed = templates.archive_by_template(
        table(spark, sf, "orders"), "o_orderdate", "%D/%Y-%m-%t.%d", db="shop", table="orders"
    )
    return routed.groupBy("archive_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_orderkey").alias("lo"),
        F.max("o_orderkey").alias("hi"),
    )


@suite.add(
    "archive_files_written",
    """SELECT event_id, event_type, strftime(ts, '%Y%m%d.') || 'events' AS archive_file FROM events""",
)
def archive_files_written(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    routed = templates.archive_by_template(events, "ts", "%Y%m%d.%t", table="events").drop("ts")
    path = new_path(spark, "template")
    templates.write_by_template(routed, path)
    return spark.read.schema(routed.schema).parquet(path)


@suite.add(
    "render_inserts",
    """SELECT 'REPLACE INTO `shop`.`cust``omer` (`c_custkey`, `c_name`, `seg`) VALUES (' || c_custkey || ', '''
         || replace(replace(n, '\\', '\\\\'), '''', '\\''') || ''', '
         || coalesce('''' || seg || '''', 'NULL') || ');' AS line
       FROM (SELECT c_custkey, replace(c_name, '#', '''\\') AS n, nullif(c_mktsegment, 'BUILDING') AS seg
             FROM customer)""",
)
def render_inserts(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.replace("c_name", F.lit("#"), F.lit("'\\")).alias("c_name"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("seg"),
    )
    return statements.render_inserts(rows, ["shop", "cust`omer"], mode="REPLACE")


_OLD = "o_orderdate < DATE '1998-01-01'"


def _orders_spec(spark, sf, **options) -> ArchiveSpec:
    base = new_path(spark, "job")
    given = {
        "source": SourceSpec("shop", "orders", path=f"{sf}/orders.parquet"),
        "where": _OLD,
        "dest": SourceSpec(path=f"{base}/dest"),
        "kept_path": f"{base}/rest",
        "keys": ("o_orderkey",),
        "chunk_rows": 500,
        **options,
    }
    return ArchiveSpec(**given)


@suite.add(
    "job_archived",
    "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'",
)
def job_archived(spark, sf):
    result = run_archive(spark, _orders_spec(spark, sf))
    return spark.read.parquet(result.dest_path)


@suite.add(
    "job_kept",
    """SELECT * FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
         AND o_orderkey < (SELECT max(o_orderkey) FROM orders))""",
)
def job_kept(spark, sf):
    spec = _orders_spec(spark, sf, autoinc_col="o_orderkey", optimize="s")
    return spark.read.parquet(run_archive(spark, spec).kept_path)


@suite.add("job_purged", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def job_purged(spark, sf):
    result = run_archive(spark, _orders_spec(spark, sf, dest=None, purge=True))
    return spark.read.parquet(result.kept_path)


@suite.add(
    "job_orphans_purged",
    """SELECT * FROM orders WHERE EXISTS (
         SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""",
)
def job_orphans_purged(spark, sf):
    """A job whose predicate looks into another table."""
    shipped = table(spark, sf, "lineitem").where("l_linestatus = 'F'")
    shipped.createOrReplaceTempView("shipped_lines")
    missing = "NOT EXISTS (SELECT * FROM shipped_lines WHERE l_orderkey = orders.o_orderkey)"
    result = run_archive(spark, _orders_spec(spark, sf, where=missing, dest=None, purge=True))
    return spark.read.parquet(result.kept_path)


@suite.add(
    "job_replaced",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
       WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
       UNION ALL
       SELECT o_orderkey, o_orderdate, 'old' FROM orders
       WHERE o_orderkey % 4 = 0 AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'""",
)
def job_replaced(spark, sf):
    path = f"{new_path(spark, 'dest')}/t"
    table(spark, sf, "orders").where("o_orderkey % 4 = 0").select(
        "o_orderkey", "o_orderdate", F.lit("old").alias("o_orderstatus")
    ).write.parquet(path)
    spec = _orders_spec(
        spark, sf, dest=SourceSpec(path=path), replace=True, bulk_insert=True,
        columns=("o_orderkey", "o_orderdate", "o_orderstatus"),
    )
    return spark.read.parquet(run_archive(spark, spec).dest_path)


@suite.add(
    "job_statistics",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderdate < TIMESTAMP '1998-01-01 00:00:00') AS a
                  FROM orders)
       SELECT 'select' AS action, 1 AS calls, n AS n_rows FROM n
       UNION ALL SELECT 'delete', 1, a FROM n
       UNION ALL SELECT 'insert', 1, a FROM n
       UNION ALL SELECT 'file', 1, a FROM n""",
)
def job_statistics(spark, sf):
    spec = _orders_spec(spark, sf)
    spec = _orders_spec(spark, sf, file=f"{spec.kept_path}-files/%Y-%t", output_format="csv")
    return run_archive(spark, spec).statistics.drop("ms")


@suite.add(
    "job_files_by_row_time",
    """SELECT strftime(o_orderdate, 'orders-%Y%m') AS archive_file,
              concat_ws(chr(9), CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_orderdate AS VARCHAR)) AS line
       FROM (SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
             WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')""",
)
def job_files_by_row_time(spark, sf):
    folder = new_path(spark, "files")
    spec = _orders_spec(
        spark, sf, dest=None, file=f"{folder}/%t-%Y%m", file_ts="o_orderdate",
        columns=("o_orderkey", "o_orderstatus", "o_orderdate"), no_delete=True, kept_path=None,
    )
    run_archive(spark, spec)
    return spark.read.text(folder).select("archive_file", F.col("value").alias("line"))


@suite.add(
    "job_files_in_year_folders",
    """WITH f AS (SELECT strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, 'orders-%m') AS archive_file, *
                FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')
       SELECT DISTINCT y AS year_folder, archive_file, '"o_orderkey","o_orderstatus"' AS line FROM f
       UNION ALL SELECT y, archive_file, concat(o_orderkey, ',"', o_orderstatus, '"') FROM f""",
)
def job_files_in_year_folders(spark, sf):
    """Codes in folder names, and the header in each file."""
    folder = new_path(spark, "files")
    spec = _orders_spec(
        spark, sf, dest=None, file=f"{folder}/%Y/%t-%m", file_ts="o_orderdate", header=True,
        output_format="csv", columns=("o_orderkey", "o_orderstatus"), no_delete=True, kept_path=None,
    )
    run_archive(spark, spec)
    lines = spark.read.option("recursiveFileLookup", "true").text(folder)
    parts = F.split(F.input_file_name(), "/")
    found = lines.select(
        F.substring_index(F.element_at(parts, -3), "=", -1).alias("year_folder"),
        F.substring_index(F.element_at(parts, -2), "=", -1).alias("archive_file"),
        F.col("value").alias("line"),
    )
    # a file name that a large share of the rows has may be several files, each with the header
    header = F.col("line") == '"o_orderkey","o_orderstatus"'
    return found.where(~header).unionByName(found.where(header).distinct())


@suite.add(
    "job_kept_compacted",
    "SELECT * FROM orders WHERE NOT o_orderdate < TIMESTAMP '1998-01-01 00:00:00'",
)
def job_kept_compacted(spark, sf):
    """What lies in the folder that the job was given, nothing more and nothing less."""
    spec = _orders_spec(spark, sf, optimize="s")
    run_archive(spark, spec)
    return spark.read.parquet(spec.kept_path)


@suite.add(
    "job_run_twice",
    "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'",
)
def job_run_twice(spark, sf):
    """A second job onto the same destination adds nothing twice."""
    spec = _orders_spec(spark, sf, ignore=True, optimize="d")
    run_archive(spark, spec)
    again = replace(spec, kept_path=f"{spec.kept_path}-again")
    return spark.read.parquet(run_archive(spark, again).dest_path)


@suite.add(
    "job_resumed",
    """SELECT *, 'archived' AS side FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
       UNION ALL
       SELECT *, 'kept' FROM orders WHERE NOT o_orderdate < TIMESTAMP '1998-01-01 00:00:00'""",
)
def job_resumed(spark, sf):
    """A job without keys that fails behind its insert, and is run again."""
    spec = _orders_spec(spark, sf, keys=(), unique_keys=False)
    spec = replace(spec, file=f"{spec.kept_path}-files")
    spark.range(1).write.parquet(spec.file)  # the place of the files is taken
    try:
        run_archive(spark, spec)
    except ValueError:
        drop_path(spark, spec.file)
        run_archive(spark, spec)
    archived, kept = (spark.read.parquet(p) for p in (spec.dest.path, spec.kept_path))
    return archived.withColumn("side", F.lit("archived")).unionByName(kept.withColumn("side", F.lit("kept")))


@suite.add(
    "hooks_spared_not_copied",
    "SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_nationkey <> 3",
)
def hooks_spared_not_copied(spark, sf):
    """The destination of a job whose hook spares rows."""
    base = new_path(spark, "hooks")
    spec = ArchiveSpec(
        source=SourceSpec("shop", "customer", path=f"{sf}/customer.parquet"),
        where="c_mktsegment <> 'BUILDING'",
        dest=SourceSpec(path=f"{base}/dest"),
        kept_path=f"{base}/rest",
        hooks=Hooks(before_delete=lambda df: df.where("c_nationkey <> 3")),
    )
    run_archive(spark, spec)
    return spark.read.parquet(spec.dest.path)


@suite.add(
    "dump_round_trip_nested",
    """SELECT event_id, list_value(event_type, NULL, 'tab' || chr(9) || 'line' || chr(10), chr(92) || ',"') AS words,
              user_id AS who_id, ts AS who_at
       FROM events""",
)
def dump_round_trip_nested(spark, sf):
    """Arrays and structs through a dump file."""
    rows = table(spark, sf, "events").select(
        "event_id",
        F.array("event_type", F.lit(None).cast("string"), F.lit("tab\tline\n"), F.lit('\\,"')).alias("words"),
        F.struct(F.col("user_id").alias("id"), F.col("ts").alias("at")).alias("who"),
    )
    path = new_path(spark, "nested")
    dump.export_dump(rows, path)
    back = dump.import_dump(spark, path, rows.schema)
    return back.select("event_id", "words", F.col("who.id").alias("who_id"), F.col("who.at").alias("who_at"))


@suite.add(
    "hooks",
    """SELECT c_custkey, concat(substr(c_name, 1, 3), '***') AS c_name, c_mktsegment FROM customer
       WHERE c_mktsegment <> 'BUILDING'""",
)
def hooks(spark, sf):
    base = new_path(spark, "hooks")
    masked = F.concat(F.substring("c_name", 1, 3), F.lit("***"))
    spec = ArchiveSpec(
        source=SourceSpec("shop", "customer", path=f"{sf}/customer.parquet"),
        where="c_mktsegment <> 'BUILDING'",
        dest=SourceSpec(path=f"{base}/dest"),
        kept_path=f"{base}/rest",
        columns=("c_custkey", "c_name", "c_mktsegment"),
        keys=("c_custkey",),
        hooks=Hooks(before_insert=lambda df: df.withColumn("c_name", masked)),
    )
    return spark.read.parquet(run_archive(spark, spec).dest_path)


@suite.add(
    "hooks_spared",
    "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' OR c_nationkey = 3",
)
def hooks_spared(spark, sf):
    base = new_path(spark, "hooks")
    spec = ArchiveSpec(
        source=SourceSpec("shop", "customer", path=f"{sf}/customer.parquet"),
        where="c_mktsegment <> 'BUILDING'",
        dest=SourceSpec(path=f"{base}/dest"),
        kept_path=f"{base}/rest",
        hooks=Hooks(before_delete=lambda df: df.where("c_nationkey <> 3")),
    )
    return spark.read.parquet(run_archive(spark, spec).kept_path)


_STREAMED = "event_type = 'click' AND nullif(user_id % 7, 2) > 1"


@suite.add(
    "stream_archived",
    f"SELECT * FROM events WHERE {_STREAMED}",
)
def stream_archived(spark, sf):
    return _streamed(spark, sf)[0]


@suite.add(
    "stream_kept",
    f"SELECT * FROM events WHERE ({_STREAMED}) IS NOT TRUE",
)
def stream_kept(spark, sf):
    return _streamed(spark, sf)[1]


def _streamed(spark, sf):
    events = table(spark, sf, "events")
    base = new_path(spark, "stream")
    events.repartition(6, "event_id").write.parquet(f"{base}/in")
    return archive_stream(
        spark, f"{base}/in", events.schema, _STREAMED, f"{base}/out", f"{base}/state", per_batch=2
    )


@suite.add(
    "compacted",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber <= 3",
)
def compacted(spark, sf):
    scattered = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    path = new_path(spark, "purged")
    scattered.where("l_linenumber <= 3").repartition(16, "l_partkey").write.parquet(path)
    return compact(spark, path, f"{path}-tidy", target_rows=10_000, keys=["l_orderkey"])


@suite.add("compacted_small", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber <= 3")
def compacted_small(spark, sf):
    """Many small files beside large ones, joined in place."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").where("l_linenumber <= 3")
    path = new_path(spark, "small")
    lines.where("l_linenumber <= 2").write.parquet(path)
    # files stay small however many rows there are
    small = lines.where("l_linenumber = 3").repartition(20, "l_partkey").write.mode("append")
    small.option("maxRecordsPerFile", 5000).parquet(path)
    compact_small(spark, path, small_bytes=64 << 10, target_bytes=256 << 10, keys=["l_orderkey"])
    return spark.read.parquet(path)


# orders in batches by date: a customer's orders have one key
_FIRST_LAST = """WITH r AS (SELECT o_custkey, o_orderkey, o_orderstatus, year(o_orderdate) AS y FROM orders
        WHERE o_orderstatus <> 'P'),
    n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY y {0}, o_orderkey {0}) AS i FROM r)
    SELECT o_custkey, o_orderkey, o_orderstatus FROM n WHERE i = 1"""


@suite.add("stream_keyed", _FIRST_LAST.format("ASC"))
def stream_keyed(spark, sf):
    """The first order of each customer, as files arrive year by year."""
    return _keyed(spark, sf, replace=False)


@suite.add("stream_keyed_replaced", _FIRST_LAST.format("DESC"))
def stream_keyed_replaced(spark, sf):
    """The last order of each customer."""
    return _keyed(spark, sf, replace=True)


def _keyed(spark, sf, replace):
    base = new_path(spark, "keyed")
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    schema = orders.drop("y").schema
    years = [r["y"] for r in orders.select("y").distinct().orderBy("y").collect()]
    for year in years:  # one batch a year, as files would arrive, of no more files than a batch takes
        orders.where(F.col("y") == year).drop("y").coalesce(64).write.mode("append").parquet(f"{base}/in")
        start_keyed_stream(
            spark, f"{base}/in", schema, "o_orderstatus <> 'P'", f"{base}/dest", f"{base}/kept", ["o_custkey"],
            f"{base}/state", replace=replace, order_by=["o_orderkey"],
        ).awaitTermination()
    return spark.read.parquet(f"{base}/dest")
