import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from coldshelf.llm import archives

SCHEMA = "page_id bigint, url string, html string, id string, digest string, first string, bundle string"
PAGES = [
    (5, "http://a/ x\r\ny", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (9, "http://c", "<p>one</p>"),
    (1, "http://d", None), (3, None, ""), (4, "http://é", "<p>zwei é 日本</p>"), (7, "http://f", "x" * 700_000),
    (8, "http://g", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n\r\n"), (None, "http://h", "<p>one</p>"), (None, "http://i", "only"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, folder):
    index = archives.write_bundles(pages(spark), folder)
    read = {(r.record_id, r.url): r for r in archives.read_bundles(index, folder).collect()}
    assert len(read) == len(PAGES) == index.count()
    for page_id, url, html in PAGES:
        clean = None if url is None else url.replace(" ", "%20").replace("\r\n", "%0D%0A")
        row = read[archives.page_urn(page_id), clean]
        assert row.payload_digest == digest(html)
        assert row.payload_bytes == len((html or "").encode())
        first = {"<p>one</p>": 2, None: 1, "": 1}.get(html)
        if first in (None, page_id):
            assert (row.record_type, row.refers_to) == ("response", None)
            assert bytes(row.payload) == (html or "").encode()
        else:
            assert (row.record_type, row.refers_to, row.payload) == ("revisit", f"urn:x-page:{first}", None)


def test_each_record_by_a_seek(spark, folder, monkeypatch):
    index = archives.write_bundles(pages(spark), folder)
    wanted = index.where(F.col("record_id").isin("urn:x-page:4", "urn:x-page:7"))
    got = {r.record_id: bytes(r.payload) for r in archives.fetch_records(wanted, folder).collect()}
    assert got == {"urn:x-page:4": "<p>zwei é 日本</p>".encode(), "urn:x-page:7": b"x" * 700_000}


def test_frames_are_independent_and_plain_decoders_read_them(tmp_path):
    writer = archives.BundleWriter(f"file://{tmp_path}")
    records = [archives.page_record(i, f"http://{i}", bytes([i % 7]) * 9000, "D", None, "2024") for i in range(120)]
    places = [writer.add(r) for r in records]
    writer.close()
    data = (tmp_path / writer.name).read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole.endswith(b"".join(records))
    system, root = archives._open(str(tmp_path))
    with system.open_input_file(f"{root}/{writer.name}") as source:
        table = archives.seek_table(source)
        assert len(table) > 3 and sum(plain for *_, plain in table) == len(whole)
        for (frame, start, length), record in zip(places, records, strict=True):
            offset, packed, plain = table[frame]
            frame_data = zstandard.ZstdDecompressor().decompress(data[offset : offset + packed], max_output_size=plain)
            assert frame_data[start : start + length] == record


def test_query_columns_small_payloads_and_repeats(spark, folder):
    rows = [*PAGES, PAGES[1]]
    found = sorted(map(tuple, archives.archive_round_trip(pages(spark, rows), folder=folder).collect()), key=str)
    expected = []
    for page_id, _, html in rows:
        first = {"<p>one</p>": 2, None: 1, "": 1}.get(html)
        revisit = first not in (None, page_id)
        expected.append((page_id, len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(expected, key=str)
    index = archives.write_bundles(pages(spark), folder + "/b", least_bytes=1)
    kinds = {r.record_id: r.record_type for r in archives.read_bundles(index, folder + "/b").collect()}
    assert kinds["urn:x-page:3"] == "response" and kinds["urn:x-page:5"] == "revisit"


def test_any_text_may_be_an_id(spark, folder):
    ids = ["None", "a b", "x\r\nWARC-Type: response", "%41", "+", "é日", "", "urn:x-page:7", None]
    rows = [(i, "http://a", f"<p>{n}</p>" if n % 2 else "same") for n, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "page_id string, url string, html string")
    found = {r.page_id: r for r in archives.archive_round_trip(frame, folder=folder).collect()}
    assert found.keys() == set(ids)
    first = min(i for i, _, html in rows if html == "same" and i is not None)
    for page_id, _, html in rows:
        assert found[page_id].payload_digest == digest(html)
        assert found[page_id].refers_to == (first if html == "same" and page_id != first else None)


def test_whole_number_ids_of_any_size(spark, folder):
    for kind in ("int", "smallint", "decimal(20,0)"):
        frame = spark.createDataFrame([(1, "u", "a"), (2, "u", "a"), (None, "u", "b")], f"page_id int, url string, html string")
        frame = frame.withColumn("page_id", F.col("page_id").cast(kind))
        result = archives.archive_round_trip(frame, folder=f"{folder}/{kind[:3]}")
        assert result.schema["page_id"].dataType.simpleString() == kind
        assert {(r.page_id, r.refers_to) for r in result.collect()} == {(1, None), (2, 1), (None, None)}


def test_bundles_are_read_by_many_tasks(spark, folder):
    index = archives.write_bundles(pages(spark).repartition(6), folder)
    bundles = index.select("bundle").distinct().count()
    read = archives.read_bundles(index, folder)
    assert bundles > 2
    counted = read.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(counted) > 1 and sum(r.n for r in counted) == len(PAGES)
    assert "REPARTITION_BY_NUM" in read._jdf.queryExecution().toString()


def test_empty_table_and_no_table(spark, folder, tmp_path):
    assert archives.archive_round_trip(pages(spark, []), folder=folder).collect() == []
    (tmp_path / "plain").write_bytes(b"no seek table in this file")
    system, root = archives._open(str(tmp_path))
    with system.open_input_file(f"{root}/plain") as source, pytest.raises(ValueError, match="seek table"):
        archives.seek_table(source)
