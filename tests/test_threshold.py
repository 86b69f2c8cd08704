"""Percentiles by selection, scalar subqueries and shared branches."""

import random

import pytest
from pyspark.sql import functions as F

from souk.operators import above_mean, above_percentile, equal_to_max, percentile_cont
from souk.plans import catalog, customers
from tests.conftest import SF_SMALL


def _frame(spark, n=700):
    rnd = random.Random(1)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.uniform(-1e6, 1e6), float(rnd.randint(0, 5))]),
             rnd.randint(1, 4)) for _ in range(n)]
    return spark.createDataFrame(rows + [("only null", None, 2), ("one", 3.5, 1)], "g string, v double, w long")


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("max_rows", [10, None])
def test_selection_equals_percentile(spark, p, max_rows):
    df = _frame(spark)
    want = {r[0]: r[1] for r in df.groupBy("g").agg(F.percentile("v", F.lit(p))).collect()}
    got = {r["g"]: r["percentile"] for r in percentile_cont(df, "v", p, ["g"], max_rows=max_rows).collect()}
    assert got == pytest.approx(want, nan_ok=True)
    whole = percentile_cont(df, "v", p, max_rows=max_rows).collect()
    assert [r[0] for r in whole] == pytest.approx([df.agg(F.percentile("v", F.lit(p))).first()[0]])
    weighted = {r[0]: r[1] for r in df.groupBy("g").agg(F.percentile("v", F.lit(p), F.col("w"))).collect()}
    got = {r["g"]: r["percentile"] for r in percentile_cont(df, "v", p, ["g"], weight="w", max_rows=max_rows).collect()}
    assert got == pytest.approx(weighted)


def test_selection_of_nothing(spark):
    df = _frame(spark).where("false")
    assert percentile_cont(df, "v", 0.5, ["g"]).count() == 0
    assert above_percentile(df, "v", 0.5).count() == 0
    with pytest.raises(ValueError):
        percentile_cont(df, "v", 1.5)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_percentile_plan_holds_no_value_map(spark):
    t = catalog.tables(spark, SF_SMALL)
    for df in (customers.customers_above_p90(t), catalog.run("category_p90_delivery", spark, SF_SMALL)):
        assert "percentile(" not in df._jdf.queryExecution().optimizedPlan().toString()
        assert "ObjectHashAggregate" not in _final_plan(df)


def test_statistics_are_scalar_subqueries(spark):
    for name in ("max_payment_orders", "products_above_avg_sales", "sellers_above_avg_revenue"):
        p = _final_plan(catalog.run(name, spark, SF_SMALL))
        assert "Subquery" in p and "NestedLoopJoin" not in p and "ReusedExchange" in p, name


def test_yearly_maximum_reads_its_joins_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _final_plan(catalog.run("beat_year_max_spend", spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the second branch joins customers to reused exchanges; payments meet orders once
    scans = [line for line in p.splitlines() if "FileScan parquet" in line and "o_totalprice" in line]
    assert len(scans) <= 2, p


def test_mean_and_maximum_edge_cases(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (3, None)], "id long, v long")
    assert above_mean(df, "v").count() == 0
    assert sorted(r["id"] for r in equal_to_max(df, "v").collect()) == [1, 2]
    assert equal_to_max(df.where("false"), "v").count() == 0 == above_mean(df.where("v is null"), "v").count()
