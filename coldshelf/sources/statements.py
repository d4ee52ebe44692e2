"""Rows as SQL statements, and quoting of names and values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MODES = ("INSERT", "INSERT IGNORE", "REPLACE")


def quote_identifier(parts: Sequence[str]) -> str:
    """Backticked parts joined by dots; a backtick inside a name is doubled."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def quote_literal(value: Any) -> str:
    """A driver-side value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (str, dt.date, dt.datetime)):
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def sql_value(field: T.StructField) -> Column:
    """A column's values as SQL literals; text and dates are quoted, the rest is raw."""
    column = F.col(field.name)
    kind = field.dataType
    if isinstance(kind, T.BinaryType):
        text = F.concat(F.lit("X'"), F.hex(column), F.lit("'"))
    elif isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        plain = column.cast("string")
        escaped = F.replace(F.replace(plain, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        text = F.concat(F.lit("'"), escaped, F.lit("'"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def render_inserts(
    df: DataFrame,
    table: str | Sequence[str],
    cols: Sequence[str] | None = None,
    mode: str = "INSERT",
) -> DataFrame:
    """One SQL statement per row, as a ``line`` column for the text sink."""
    if mode not in _MODES:
        raise ValueError(f"mode must be one of {_MODES}")
    rows = df.select(*cols) if cols else df
    target = quote_identifier([table] if isinstance(table, str) else table)
    names = ", ".join(quote_identifier([c]) for c in rows.columns)
    values = F.concat_ws(", ", *[sql_value(f) for f in rows.schema.fields])
    return rows.select(
        F.concat(F.lit(f"{mode} INTO {target} ({names}) VALUES ("), values, F.lit(");")).alias("line")
    )
