"""Tables of server version strings such as ``8.0.30-22.1``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# \z rather than $, which in Java also matches before a final line feed
_VALID = r"^([58])\.([0-9])\.([0-9]{1,2})(-[^\n]*)?\z"


def is_version(text: Column) -> Column:
    return F.coalesce(text.rlike(_VALID), F.lit(False))


def _part(text: Column, group: int) -> Column:
    return F.regexp_extract(text, _VALID, group)


def normalized_version(text: Column) -> Column:
    """``8.0.30`` as ``80030``; NULL for an invalid version.  Sorts like the version."""
    digits = [_part(text, i).cast("int") for i in (1, 2, 3)]
    return F.when(is_version(text), F.format_string("%d%02d%02d", *digits))


def version_audit(df: DataFrame, col: str, floor: str | None = None) -> DataFrame:
    """Add ``valid, major, minor, release, normalized`` and the comparison with a floor.

    ``vs_floor`` is -1, 0 or 1 for older, same or newer than ``floor``; releases do not
    count.  All of them are NULL for an invalid version.
    """
    text = F.col(col)
    valid = is_version(text)
    release = _part(text, 4)
    out = df.withColumns(
        {
            "valid": valid,
            "major": F.when(valid, _part(text, 1)),
            "minor": F.when(valid, F.concat(_part(text, 2), F.lit("."), _part(text, 3))),
            "release": F.when(valid, F.when(release == "", F.lit("-")).otherwise(release)),
            "normalized": normalized_version(text),
        }
    )
    if floor is None:
        return out
    limit = normalized_version(F.lit(floor))
    order = (
        F.when(F.col("normalized") < limit, -1)
        .when(F.col("normalized") > limit, 1)
        .when(F.col("normalized") == limit, 0)
    )
    return out.withColumn("vs_floor", order)


def latest_version(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    """The newest valid version per group; between releases of one version the last in
    text order."""
    text = F.col(col)
    # few distinct versions remain of many rows, combined by hash before the shuffle
    found = df.where(is_version(text)).select(*by, col).distinct()
    return (
        found.groupBy(*by)
        .agg(F.max(F.struct(normalized_version(text).alias("n"), text.alias("v"))).alias("_m"))
        .select(*by, F.col("_m.v").alias("latest"), F.col("_m.n").alias("normalized"))
    )
