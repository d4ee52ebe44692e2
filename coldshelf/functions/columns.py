"""Small helpers for building column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    Inside a lambda a plain expression would be computed again for every element, which
    makes long arrays quadratic; a lambda's own variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
