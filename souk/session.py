"""Spark session helpers.

Library code never creates a session on its own; callers (tests, bench, the
driver) pass one in.  ``configure`` applies the runtime SQL settings every
report relies on to an existing session, ``local_session`` builds a local one
for tests and benchmarks.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime SQL settings the reports assume.  All are settable on a live
# session, so they also apply to a session the caller built.
RUNTIME_CONF = {
    # Timestamps are TIMESTAMP_NTZ; pin the zone so date casts never shift.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, turn sort-merge
    # joins into broadcast joins once the real (post-shuffle) size is known,
    # and split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the reports assume to ``spark``."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "souk", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, no ports beyond
    Spark's own driver endpoints)."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SOUK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.default.parallelism", str(n))
    )
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
