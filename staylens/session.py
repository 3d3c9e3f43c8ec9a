"""SparkSession construction for tests, the bench and local runs.

Library operators never build or configure a session: the caller owns it. This
helper only exists so tests and ``bench.py`` start Spark the same way.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "staylens",
    driver_memory: str = "8g",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for AQE, UTC and no web UI.

    * AQE re-plans at runtime: it coalesces small shuffle partitions, turns a
      sort-merge join into a broadcast join only after it has *measured* the
      small side (a size-checked broadcast with the shuffle join as fallback),
      and splits skewed join partitions.
    * ``spark.sql.shuffle.partitions`` is the pre-AQE partition count; on a
      cluster size it to ~ (shuffle bytes / 128 MB) and let AQE coalesce.
    """
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
