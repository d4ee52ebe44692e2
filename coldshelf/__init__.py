"""coldshelf: archive, purge, compare and audit large tables with Spark.

Every public function takes and returns DataFrames.  Rows are never collected to the
driver; only sizes with a fixed bound (one number per range partition, one row per
job counter) are.
"""

from coldshelf.session import build_session

__all__ = ["build_session"]
