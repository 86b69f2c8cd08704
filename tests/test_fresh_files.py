"""A report reads the files that are there when it is called; orderings hold
row by row."""

import glob
import shutil

from pyspark.sql import functions as F

from souk.plans import catalog
from tests.conftest import SF_SMALL


def test_files_added_between_two_runs(spark, tmp_path):
    for f in glob.glob(f"{SF_SMALL}/*.parquet"):
        if "orders" in f or "lineitem" in f:
            spark.read.parquet(f).limit(200).write.parquet(f"{tmp_path}/{f.rsplit('/', 1)[1]}")
        else:
            shutil.copy(f, tmp_path)

    def orders() -> int:
        return catalog.run("monthly_orders", spark, str(tmp_path)).agg(F.sum("total_orders")).first()[0]

    before = orders()
    more = spark.read.parquet(f"{SF_SMALL}/orders.parquet").limit(200)
    more.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert orders() == 2 * before


def test_running_sales_rise_within_a_customer(spark):
    last: dict[int, float] = {}
    for r in catalog.run("customer_running_sales", spark, SF_SMALL).collect():
        assert r["cumulative_sales"] >= last.get(r["customer_id"], 0.0)
        last[r["customer_id"]] = r["cumulative_sales"]
