"""Local session for tests and the benchmark.

Library operators never change session settings; callers bring their own
session.  This builder is for running on one machine only.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll", extra: dict | None = None
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
