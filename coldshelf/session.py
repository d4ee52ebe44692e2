"""Session defaults used by the tests, the benchmark and local runs.

On a cluster the session comes from the platform; nothing in the library sets
configuration on it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "coldshelf", master: str = "local[8]", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
