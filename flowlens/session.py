"""Session helpers for tests, the bench and local runs.

Library operators never create sessions; they take DataFrames.  On a cluster
the session comes from the platform and its settings win.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every flowlens plan assumes.  AQE coalesces small shuffles, turns
# joins whose runtime side is small into broadcast joins (a size-checked
# broadcast with sort-merge as the fallback) and splits skewed join
# partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "flowlens", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured like the cluster one (tests and bench)."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("FLOWLENS_DRIVER_MEMORY", "8g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for key, value in (RECOMMENDED_CONF | (extra or {})).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
