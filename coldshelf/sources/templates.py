"""Archive file names from a template, one file (folder) per row timestamp."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: template code -> date pattern
_CODES = {"d": "dd", "H": "HH", "i": "mm", "m": "MM", "s": "ss", "Y": "yyyy"}


def archive_name(ts: Column, template: str, db: str = "", table: str = "") -> Column:
    """``%d %H %i %m %s %Y`` from the timestamp, ``%D`` and ``%t`` from the source.

    A code that is not known stays as it is.
    """
    parts = []
    for text, code in re.findall(r"([^%]+|%(?![dHimsYDt]))|%([dHimsYDt])", template):
        if text:
            parts.append(F.lit(text))
        elif code in ("D", "t"):
            parts.append(F.lit(db if code == "D" else table))
        else:
            parts.append(F.date_format(ts, _CODES[code]))
    return F.concat(*parts) if parts else F.lit("")


def archive_by_template(
    df: DataFrame,
    ts_col: str | None,
    template: str,
    db: str = "",
    table: str = "",
    name_col: str = "archive_file",
) -> DataFrame:
    """Rows with the name of the archive file they belong to.

    Without ``ts_col`` the time of the run names one file for all rows.
    """
    ts = F.col(ts_col) if ts_col else F.current_timestamp()
    return df.withColumn(name_col, archive_name(ts, template, db, table))


def fixed_folder(template: str) -> str:
    """The folders of a path template that come before its first code."""
    code = re.search(r"%[dHimsYDt]", template)
    return template if code is None else template[: code.start()].rpartition("/")[0]


def write_by_template(
    routed: DataFrame, path: str, format: str = "parquet", name_col: str = "archive_file"
) -> None:
    """One folder per archive file.

    The rebalance hint gathers small files and lets adaptive execution split a name that
    holds a large share of the rows.
    """
    routed.hint("rebalance", F.col(name_col)).write.partitionBy(name_col).format(format).save(path)


def render_name(template: str, when: dt.datetime, db: str = "", table: str = "") -> str:
    """The name a template gives for one moment."""
    # fixed values: template code -> strftime code
    codes = {"d": "%d", "H": "%H", "i": "%M", "m": "%m", "s": "%S", "Y": "%Y"}
    names = {"D": db, "t": table}
    return re.sub(
        r"%([dHimsYDt])",
        lambda m: names[m[1]] if m[1] in names else when.strftime(codes[m[1]]),
        template,
    )
