"""Co-located storage: the tables keyed by order as bucketed, sorted tables.

``orders``, ``order_items``, ``order_payments`` and ``order_reviews`` are
written with the same number of buckets on ``order_id`` (one file for each
bucket, sorted by it).  Spark then joins and groups them by order without
moving either side: per-order totals and their join with orders are sort-merge
work inside each bucket.  The other tables are written plain.

``write_bucketed`` saves them through the session's catalog; ``declare``
makes the same tables known to a session whose catalog does not keep them
(same database name, same root, same number of buckets); ``bucketed_tables``
reads them as a :class:`Tables` bundle.

A bucket is one task's work, so the number of buckets should give files of a
few hundred MB.  Bucketed scans are not split: an order with a large share of
all items would make one long task, unlike the shuffled plans.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from souk.sources.tables import SCHEMAS, Tables

BY_ORDER = ("orders", "order_items", "order_payments", "order_reviews")


def _check(database: str, buckets: int) -> None:
    if not database.isidentifier():
        raise ValueError("database must be a plain name")
    if buckets < 1:
        raise ValueError("buckets must be at least 1")


def write_bucketed(t: Tables, database: str, root: str, buckets: int, mode: str = "errorifexists") -> None:
    """Write all tables of ``t`` below ``root`` as tables of ``database``."""
    _check(database, buckets)
    spark = t.orders.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in SCHEMAS:
        df = getattr(t, name)
        if name in BY_ORDER:
            # the shuffle deals rows as the buckets do: one file for each bucket
            out = df.repartition(buckets, "order_id").write.bucketBy(buckets, "order_id").sortBy("order_id")
        else:
            out = df.write
        out.format("parquet").mode(mode).option("path", f"{root}/{name}").saveAsTable(f"{database}.{name}")


def declare(spark: SparkSession, database: str, root: str, buckets: int) -> None:
    """Declare tables that :func:`write_bucketed` wrote below ``root``."""
    _check(database, buckets)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in SCHEMAS:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                            for f in spark.read.parquet(f"{root}/{name}").schema.fields)
        layout = f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {buckets} BUCKETS" if name in BY_ORDER else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {layout} "
                  f"LOCATION '{root}/{name}'")


def bucketed_tables(spark: SparkSession, database: str) -> Tables:
    """The tables of ``database`` as a bundle."""
    return Tables(**{name: (lambda n=name: spark.table(f"{database}.{n}")) for name in SCHEMAS})
