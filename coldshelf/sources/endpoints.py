"""Where rows come from and go to."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldshelf.sources.statements import quote_identifier, quote_literal


@dataclass(frozen=True)
class SourceSpec:
    """A table: files below ``path``, a JDBC table if ``url`` is set, else a catalog table."""

    database: str | None = None
    table: str | None = None
    path: str | None = None
    format: str = "parquet"
    url: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    predicates: Sequence[str] = ()

    def inherit(self, source: SourceSpec) -> SourceSpec:
        """Fill the missing parts of a destination from its source.

        The path is not inherited: a destination never shares its source's files.
        """
        return replace(
            self,
            database=self.database or source.database,
            table=self.table or source.table,
            url=self.url or (source.url if self.path is None else None),
        )

    def same_place(self, other: SourceSpec) -> bool:
        def place(s: SourceSpec):
            return (plain_path(s.path),) if s.path else (s.url, s.database, s.table)

        return place(self) == place(other)


def plain_path(path: str) -> str:
    """A path without the forms in which it can be written: ``file:``, double and last slashes."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        scheme, rest = "", path
    authority = re.match(r"//[^/]+", rest)
    named = f"{scheme}:{authority[0]}" if authority else "" if scheme in ("", "file") else f"{scheme}:"
    return named + posixpath.normpath("/" + rest.removeprefix(authority[0] if authority else "").lstrip("/"))


def inside(path: str, folder: str) -> bool:
    """Is ``path`` the folder itself or below it?"""
    return f"{plain_path(path)}/".startswith(f"{plain_path(folder)}/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path as its file system writes it, with scheme and host."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def check_endpoints(source: SourceSpec, dest: SourceSpec | None = None) -> SourceSpec | None:
    """Validate a pair of endpoints and return the completed destination."""
    if not source.table:
        raise ValueError("source must name a table")
    if not source.database:
        raise ValueError("source must name a database")
    if dest is None:
        return None
    dest = dest.inherit(source)
    if dest.same_place(source):
        raise ValueError("source and dest must differ")
    return dest


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    options = {"url": spec.url, "dbtable": ".".join(quote_identifier([p]) for p in (spec.database, spec.table) if p)}
    return {**options, **spec.options}


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Resolve an endpoint to a DataFrame.

    For a database table each entry of ``predicates`` becomes one partition of the read;
    ``jdbc_predicates`` makes them from a chunk manifest.
    """
    if spec.url:
        options = jdbc_options(spec)
        if spec.predicates:
            table = options.pop("dbtable")
            url = options.pop("url")
            return spark.read.jdbc(url, table, predicates=list(spec.predicates), properties=options)
        return spark.read.format("jdbc").options(**options).load()
    if spec.path:
        return spark.read.format(spec.format).options(**spec.options).load(spec.path)
    return spark.table(f"{spec.database}.{spec.table}" if spec.database else spec.table)


def jdbc_predicates(
    manifest: DataFrame, keys: Sequence[str], partitions: int | None = None, range_rows: int = 1_000_000
) -> list[str]:
    """WHERE conditions that cut a table into at most ``partitions`` key ranges.

    Unless given, there are as many as make ranges of ``range_rows`` rows.  Neighbouring chunks of the manifest share a range.  The first range is open below
    and the last one above, so rows that arrived since the manifest was made are read.
    Only the lower edges of the ranges, ``partitions`` rows, come to the driver.
    """
    count = manifest.agg(F.count(F.lit(1)).alias("n")).scalar()
    if partitions is None:
        rows = manifest.agg(F.sum("n_rows").alias("n")).first()["n"] or 0
        partitions = max(1, -(-int(rows) // range_rows))
    edges = (
        manifest.withColumn("_n", count)
        .withColumn("_range", F.expr(f"chunk_id * {int(partitions)} DIV _n"))
        .groupBy("_range")
        .agg(F.min_by("lo", "chunk_id").alias("lo"))
        .orderBy("_range")
        .collect()
    )
    lows = [[row["lo"][k] for k in keys] for row in edges]
    if len(lows) < 2:
        return ["1=1"]
    return [
        _seek_sql(keys, lows[1], "<"),
        *(
            f"{_seek_sql(keys, low, '>=')} AND {_seek_sql(keys, high, '<')}"
            for low, high in zip(lows[1:], lows[2:])
        ),
        _seek_sql(keys, lows[-1], ">="),
    ]


def _seek_sql(keys: Sequence[str], values: Sequence[Any], op: str) -> str:
    """Rows before (``<``) or from (``>=``) a key tuple on, as SQL text, NULLS FIRST."""
    branches, equal = [], []
    for key, value in zip(keys, values):
        name, literal = quote_identifier([key]), quote_literal(value)
        if op == "<":
            beyond = None if value is None else f"({name} < {literal} OR {name} IS NULL)"
        else:
            beyond = f"{name} IS NOT NULL" if value is None else f"{name} > {literal}"
        if beyond:
            branches.append(" AND ".join([*equal, beyond]))
        equal.append(f"{name} IS NULL" if value is None else f"{name} = {literal}")
    if op == ">=":
        branches.append(" AND ".join(equal))
    return "(" + " OR ".join(f"({b})" for b in branches or ["1=0"]) + ")"
