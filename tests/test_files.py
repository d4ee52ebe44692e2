import datetime as dt
import random
from collections import Counter
from pathlib import Path

import pytest

from coldshelf.operators.chunks import chunk_manifest
from coldshelf.operators.compact import compact
from coldshelf.sources import dump, statements, templates
from coldshelf.sources.endpoints import (
    SourceSpec, check_endpoints, jdbc_options, jdbc_predicates, read_source,
)

SCHEMA = "id bigint, t string, n int, at timestamp_ntz, d decimal(9,2), b boolean"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def awkward(spark):
    """Texts full of escapes, NULLs, marker characters and long values."""
    rng = random.Random(11)
    pieces = ["\t", "\n", "\\", "\\N", "N", "a", "\u0001", "\u0001A", "\r", "\\\n", "é", " "]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(8))) for _ in range(400)]
    texts += [None, "", "\\N", "\\", "\n", "\n\n", "\\\\\n", "x" * 300_000, "\\\n" * 30_000]
    rows = [
        (i, t, None if i % 3 else i, dt.datetime(2024, 1, 1, 0, 0, i % 60), None if i % 5 else "1.50", i % 2 == 0)
        for i, t in enumerate(texts)
    ]
    df = spark.createDataFrame(
        [(i, t, n, a, b) for i, t, n, a, _, b in rows], "id bigint, t string, n int, at timestamp_ntz, b boolean"
    )
    return df.selectExpr("id", "t", "n", "at", "CAST(id AS decimal(9,2)) AS d", "b").cache()


@pytest.mark.parametrize("header", [False, True])
def test_dump_round_trip(spark, folder, awkward, header):
    dump.export_dump(awkward.repartition(3), f"{folder}/d", header=header)
    assert bag(dump.import_dump(spark, f"{folder}/d", SCHEMA, header=header)) == bag(awkward)


@pytest.mark.parametrize("size", ["40", "1000", "65536"])
def test_records_cut_by_file_splits(spark, folder, awkward, size):
    small = awkward.where("id < 30") if size == "40" else awkward
    dump.export_dump(small.coalesce(2), f"{folder}/d", header=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = dump.import_dump(spark, f"{folder}/d", SCHEMA, header=True)
        assert bag(found) == bag(small)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_bytes_are_not_read_as_text(spark, folder):
    dump.export_dump(spark.createDataFrame([(bytearray(b"a\xff"),)], "b binary"), f"{folder}/d")
    with pytest.raises(ValueError):
        dump.import_dump(spark, f"{folder}/d", "b binary")


def test_dump_text(spark, folder):
    df = spark.createDataFrame([("a\tb\nc\\d", None, 1)], "x string, `y\t` string, z int")
    assert dump.dump_lines(df).first().line == "a\\\tb\\\nc\\\\d\t\\N\t1"
    assert dump.dump_lines(df, ["z", "x"]).first().line.startswith("1\t")
    dump.export_dump(df.coalesce(1), f"{folder}/d", header=True)
    (part,) = Path(folder, "d").glob("part-*")
    assert part.read_text() == "x\ty\\\t\tz\na\\\tb\\\nc\\\\d\t\\N\t1\n"


def test_every_file_has_one_header(spark, folder):
    dump.export_csv(spark.range(100).repartition(4), f"{folder}/d", header=True)
    parts = [p.read_text().split("\n") for p in Path(folder, "d").glob("part-*") if p.stat().st_size]
    assert len(parts) == 4
    assert all(lines[0] == '"id"' and lines.count('"id"') == 1 for lines in parts)


def test_csv_text(spark):
    df = spark.createDataFrame([('say "hi", \\', None, 2.5, None)], "a string, b string, c double, d int")
    assert dump.csv_lines(df).first().line == '"say \\"hi\\", \\\\",\\N,2.5,\\N'


def test_files_are_bounded(spark, folder):
    dump.export_dump(spark.range(95).coalesce(1), f"{folder}/d", rows_per_file=10)
    assert len(list(Path(folder, "d").glob("part-*"))) == 10


def test_identifier_quoting():
    assert statements.quote_identifier([]) == ""
    assert statements.quote_identifier(["a"]) == "`a`"
    assert statements.quote_identifier(["a", "b"]) == "`a`.`b`"
    assert statements.quote_identifier(["a`b", " c "]) == "`a``b`.` c `"


def test_statements(spark):
    df = spark.createDataFrame(
        [(1, "it's \\", None, dt.date(2024, 5, 6)), (2, "", True, None)], "i int, s string, b boolean, d date"
    )
    lines = [r.line for r in statements.render_inserts(df, ["d`b", "t"], mode="INSERT IGNORE").collect()]
    head = "INSERT IGNORE INTO `d``b`.`t` (`i`, `s`, `b`, `d`) VALUES "
    assert lines == [
        head + "(1, 'it\\'s \\\\', NULL, '2024-05-06');",
        head + "(2, '', true, NULL);",
    ]
    assert statements.render_inserts(df, "t", ["s"]).first().line.startswith("INSERT INTO `t` (`s`)")
    with pytest.raises(ValueError):
        statements.render_inserts(df, "t", mode="MERGE")


def test_file_name_templates(spark):
    moment = dt.datetime(2024, 3, 4, 5, 6, 7)
    df = spark.createDataFrame([(moment,), (None,)], "at timestamp_ntz")
    template = "/log/%Y-%m-%d_%H.%i.%s-%D.%t%q%"
    names = [r.archive_file for r in templates.archive_by_template(df, "at", template, "db", "tbl").collect()]
    assert names[0] == "/log/2024-03-04_05.06.07-db.tbl%q%"
    assert templates.render_name(template, moment, "db", "tbl") == names[0]
    fixed = templates.archive_by_template(df, None, "%D.%t", "db", "tbl")
    assert {r.archive_file for r in fixed.collect()} == {"db.tbl"}


def test_endpoint_rules(spark):
    source = SourceSpec("db", "t", path="/a/t")
    for broken in (SourceSpec(None, "t"), SourceSpec("db", None)):
        with pytest.raises(ValueError):
            check_endpoints(broken)
    assert check_endpoints(source) is None
    dest = check_endpoints(source, SourceSpec(path="/b/t"))
    assert (dest.database, dest.table) == ("db", "t")
    with pytest.raises(ValueError):
        check_endpoints(source, SourceSpec(path="/a/t/"))
    jdbc = SourceSpec("db", "t", url="jdbc:mysql://h/")
    with pytest.raises(ValueError):
        check_endpoints(jdbc, SourceSpec())
    assert check_endpoints(jdbc, SourceSpec(table="u")).url == jdbc.url
    assert jdbc_options(jdbc) == {"url": "jdbc:mysql://h/", "dbtable": "`db`.`t`"}


def test_read_source_from_path_and_catalog(spark, folder):
    spark.range(3).write.json(f"{folder}/j")
    assert read_source(spark, SourceSpec("d", "t", path=f"{folder}/j", format="json")).count() == 3
    spark.range(4).createOrReplaceTempView("four")
    assert read_source(spark, SourceSpec(None, "four")).count() == 4


def test_jdbc_ranges_cover_every_row_once(spark):
    rows = [(i % 7 if i % 5 else None, f"it's {i}") for i in range(300)] + [(None, None)]
    df = spark.createDataFrame(rows, "k int, s string").cache()
    manifest = chunk_manifest(df, ["k", "s"], 10)
    for partitions in (1, 4, 30):
        conditions = jdbc_predicates(manifest, ["k", "s"], partitions)
        assert 1 <= len(conditions) <= partitions
        hits = [df.where(c) for c in conditions]
        assert sum(h.count() for h in hits) == len(rows)


def test_compaction_spreads_equal_keys(spark, folder):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, id, 5) AS k", "id")
    df.repartition(20).write.parquet(f"{folder}/old")
    new = compact(spark, f"{folder}/old", f"{folder}/new", target_rows=100, keys=["k"])
    assert bag(new) == bag(df)
    counts = [spark.read.parquet(str(p)).count() for p in Path(folder, "new").glob("part-*")]
    assert max(counts) <= 100 and len(counts) <= 20
    for part in Path(folder, "new").glob("part-*"):
        keys = [r.k for r in spark.read.parquet(str(part)).select("k").collect()]
        assert keys == sorted(keys)
    assert bag(compact(spark, f"{folder}/old", f"{folder}/plain", target_rows=600)) == bag(df)


def test_headers_in_files_of_bounded_size(spark, folder):
    rows = spark.range(25).selectExpr("id", "'x' AS t").coalesce(1)
    dump.export_csv(rows, f"{folder}/csv", header=True, rows_per_file=10)
    files = sorted(Path(f"{folder}/csv").glob("part-*"))
    assert len(files) == 3
    assert all(f.read_text().startswith('"id","t"\n') for f in files)
    assert sum(len(f.read_text().splitlines()) - 1 for f in files) == 25


def test_nested_values_in_lines(spark, folder):
    frame = spark.createDataFrame(
        [(1, ["a\tb", None, 'c"d,', "\\"], {"k\n": 2}, (7, None)), (2, None, None, None), (3, [], {}, (None, "x"))],
        "id int, l array<string>, m map<string,int>, s struct<a:int,b:string>",
    )
    dump.export_dump(frame, f"{folder}/dump")
    back = dump.import_dump(spark, f"{folder}/dump", frame.schema)
    assert sorted(back.collect()) == sorted(frame.collect())
    line = dump.csv_lines(frame.where("id = 1").select("id", "l")).first().line
    assert line == '1,"[\\"a\\\\tb\\",null,\\"c\\\\\\"d,\\",\\"\\\\\\\\\\"]"'


def test_ranges_follow_the_number_of_rows(spark):
    manifest = spark.createDataFrame([(i, 100, {"id": i * 100}) for i in range(50)], "chunk_id bigint, n_rows bigint, lo struct<id:bigint>")
    assert len(jdbc_predicates(manifest, ["id"], range_rows=1000)) == 5
    assert len(jdbc_predicates(manifest, ["id"])) == 1
