"""Qualified table names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PART = r"(`(?:[^`]|``)*+`|[^.`]++)"
_QUALIFIED = rf"^\s*(?:{_PART}\.)?{_PART}\s*\z"


def _unquote(part):
    inner = F.regexp_replace(part, r"^`|`\z", "")
    return F.when(part.startswith("`"), F.replace(inner, F.lit("``"), F.lit("`"))).otherwise(part)


def qualify_names(df: DataFrame, col: str, default_db: str) -> DataFrame:
    """Add ``db`` and ``tbl``: a possibly backticked name, split at the dot outside quotes.

    Without a database part ``default_db`` is used; a name that cannot be read gives NULL.
    """
    name = F.col(col)
    db = F.regexp_extract(name, _QUALIFIED, 1)
    tbl = F.regexp_extract(name, _QUALIFIED, 2)
    ok = name.rlike(_QUALIFIED)
    return df.withColumns(
        {
            "db": F.when(ok, F.when(db == "", F.lit(default_db)).otherwise(_unquote(db))),
            "tbl": F.when(ok, _unquote(tbl)),
        }
    )
