"""Dump and CSV files: one line per row, NULL as ``\\N``, backslash escapes.

Dump fields are separated by tabs; tab, line feed and backslash are escaped by a
backslash.  CSV text fields are enclosed in double quotes; quote and backslash inside
them are escaped.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from coldshelf.plans.staging import stage

_NULL = r"\N"
# Marks decoded escapes while fields are split; the mark itself is escaped first, so any
# text survives.
_MARK = "\u0001"


def _escaped(column: Column, specials: Sequence[str]) -> Column:
    out = F.replace(column, F.lit("\\"), F.lit("\\\\"))
    for char in specials:
        out = F.replace(out, F.lit(char), F.lit("\\" + char))
    return out


# times inside of JSON keep their microseconds
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType)) or _is_nested(kind)


def _text(field: T.StructField) -> Column:
    """A field as text; arrays, maps and structs are JSON."""
    if _is_nested(field.dataType):
        return F.to_json(F.col(field.name), {"ignoreNullFields": "false", **_JSON})
    return F.col(field.name).cast("string")


def dump_line(schema: T.StructType) -> Column:
    """A row of ``schema`` in dump format."""
    return F.concat_ws(
        "\t",
        *[
            F.coalesce(
                _escaped(_text(f), ["\t", "\n"]) if _is_text(f.dataType) else _text(f),
                F.lit(_NULL),
            )
            for f in schema.fields
        ],
    )


def csv_line(schema: T.StructType) -> Column:
    """A row of ``schema`` with comma-separated fields, text enclosed in double quotes."""
    quote = F.lit('"')
    return F.concat_ws(
        ",",
        *[
            F.coalesce(
                F.concat(quote, _escaped(_text(f), ['"']), quote) if _is_text(f.dataType) else _text(f),
                F.lit(_NULL),
            )
            for f in schema.fields
        ],
    )


def dump_lines(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in dump format, one ``line`` each."""
    rows = df.select(*cols) if cols else df
    return rows.select(dump_line(rows.schema).alias("line"))


def csv_lines(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows in CSV format, one ``line`` each."""
    rows = df.select(*cols) if cols else df
    return rows.select(csv_line(rows.schema).alias("line"))


def _with_header(lines: DataFrame, header: str, rows_per_file: int) -> DataFrame:
    """Put the header before the first row of every file.

    A task begins a new file after each ``rows_per_file`` rows.
    """
    row_in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.concat(F.lit(header + "\n"), F.col("line"))
    begins = row_in_partition % rows_per_file == 0 if rows_per_file > 0 else row_in_partition == 0
    return lines.select(F.when(begins, first).otherwise(F.col("line")).alias("line"))


def write_lines(
    lines: DataFrame, path: str, header: str | None, mode: str = "errorifexists", rows_per_file: int = 1_000_000
) -> None:
    """Write finished lines as text files, each with the header if there is one."""
    if header is not None:
        lines = _with_header(lines, header, rows_per_file)
    lines.write.mode(mode).option("maxRecordsPerFile", rows_per_file).text(path)


def header_line(columns: Sequence[str], csv: bool = False) -> str:
    """The line that names the fields."""
    if csv:
        return ",".join('"' + n.replace("\\", "\\\\").replace('"', '\\"') + '"' for n in columns)
    return "\t".join(n.replace("\\", "\\\\").replace("\t", "\\\t").replace("\n", "\\\n") for n in columns)


def export_dump(
    df: DataFrame,
    path: str,
    cols: Sequence[str] | None = None,
    header: bool = False,
    mode: str = "errorifexists",
    rows_per_file: int = 1_000_000,
) -> None:
    """Write rows in dump format, at most ``rows_per_file`` in one file."""
    line = header_line(cols or df.columns) if header else None
    write_lines(dump_lines(df, cols), path, line, mode, rows_per_file)


def export_csv(
    df: DataFrame,
    path: str,
    cols: Sequence[str] | None = None,
    header: bool = False,
    mode: str = "errorifexists",
    rows_per_file: int = 1_000_000,
) -> None:
    """Write rows as CSV with optionally enclosed fields."""
    line = header_line(cols or df.columns, csv=True) if header else None
    write_lines(csv_lines(df, cols), path, line, mode, rows_per_file)


def _join_continued():
    """Join lines that end in an escaped line feed, within each piece of a file.

    The first record of a piece may continue the piece before it, and its last one may go
    on in the next; these two come out as fragments (``place`` 0 and 1), all others as
    whole records (``place`` NULL).  Lines without any such neighbour pass in bulk.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "start", "place", "open", "value"]
        piece = None
        pending: list[str] = []
        place = 0

        def rows(found):
            columns = zip(*found)
            types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
            )

        was_open = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            file, start, is_open, _ = batch.columns
            opens = is_open.to_numpy(zero_copy_only=False)
            starts = start.to_numpy()
            # dictionary codes: comparing them finds where the next piece begins
            files = file.dictionary_encode().indices.to_numpy()
            begins = np.ones(len(opens), dtype=bool)
            begins[1:] = (starts[1:] != starts[:-1]) | (files[1:] != files[:-1])
            begins[0] = (file[0].as_py(), start[0].as_py()) != piece
            follows = np.concatenate([[was_open], opens[:-1]])
            joins = opens | follows | begins
            was_open = bool(opens[-1])

            whole = batch.filter(pa.array(~joins))
            if whole.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0), whole.column(1), pa.nulls(whole.num_rows, pa.int32()), *whole.columns[2:]],
                    names=names,
                )
            found = []
            touched = batch.filter(pa.array(joins))
            for f, s, o, value in zip(*(c.to_pylist() for c in touched.columns)):
                if (f, s) != piece:
                    if pending:
                        found.append((*piece, place, True, "\n".join(pending)))
                    piece, pending, place = (f, s), [], 0
                pending.append(value)
                if not o:
                    found.append((*piece, 0 if place == 0 else None, False, "\n".join(pending)))
                    pending, place = [], 1
            if found:
                yield rows(found)
        if pending:
            yield rows([(*piece, place, True, "\n".join(pending))])

    return join


def read_records(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """The records of dump files as column ``value``, still escaped.

    Files are read in pieces like any text file, so a large file is no obstacle: a record
    cut by the border of two pieces is put together from its fragments, of which there
    are two per piece.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    slashes = F.length("value") - F.length(F.rtrim("value", F.lit("\\")))
    is_open = slashes % 2 == 1
    if not header and lines.where(is_open).isEmpty():
        return lines  # every line is a record
    pieces = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        is_open.alias("open"),
        "value",
    ).mapInArrow(_join_continued(), "file string, start bigint, place int, open boolean, value string")
    pieces = stage(pieces, "records")

    in_file = W.partitionBy("file").orderBy("start", "place")
    fragments = pieces.where("place IS NOT NULL").withColumn(
        "_new", F.when(F.lag("open", 1, False).over(in_file), 0).otherwise(1)
    )
    joined = (
        fragments.withColumn("_record", F.sum("_new").over(in_file))
        .groupBy("file", "_record")
        .agg(F.sort_array(F.collect_list(F.struct("start", "place", "value"))).alias("_parts"))
        .withColumn("value", F.array_join("_parts.value", "\n"))
    )
    if header:
        joined = joined.where("_record > 1")
    return pieces.where("place IS NULL").select("value").unionByName(joined.select("value"))


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of escaped records in column ``value``.

    Escapes are replaced by marker pairs before the fields are split; only literal
    replacements are used, as looping regular expressions overflow on long texts.
    """
    marked = F.col("value")
    for text, code in ((_MARK, "A"), ("\\\\", "B"), ("\\\t", "C"), ("\\\n", "D")):
        marked = F.replace(marked, F.lit(text), F.lit(_MARK + code))

    def restore(column: Column) -> Column:
        for code, char in (("B", "\\"), ("C", "\t"), ("D", "\n"), ("A", _MARK)):
            column = F.replace(column, F.lit(_MARK + code), F.lit(char))
        return column

    fields = records.select(F.split(marked, "\t", -1).alias("_f"))
    def typed(i: int, kind: T.DataType) -> Column:
        text = F.when(F.get("_f", F.lit(i)) != _NULL, restore(F.get("_f", F.lit(i))))
        return F.from_json(text, kind, _JSON) if _is_nested(kind) else text.cast(kind)

    return fields.select(*[typed(i, f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def import_dump(
    spark: SparkSession, path: str, schema: T.StructType | str, header: bool = False
) -> DataFrame:
    """Read dump files back into typed rows."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = [f.name for f in schema.fields if isinstance(f.dataType, T.BinaryType)]
    if raw:
        raise ValueError(f"fields are read as text, which cannot hold any bytes: {raw}")
    return parse_records(read_records(spark, path, header), schema)
