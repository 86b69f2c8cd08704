"""Bucketed tables, the SQL table function, sketches."""

import pytest
from pyspark.sql import functions as F

from souk.operators.sketches import relative_error
from souk.plans import catalog, customers, procedures, rollups
from souk.sources import bucketed, read_tables
from souk.sources.tables import SCHEMAS
from tests.conftest import SF_CHECK, SF_SMALL


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is not None, v if v is not None else 0) for v in r))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucketed"))
    bucketed.write_bucketed(catalog.tables(spark, SF_SMALL), "souk_test", root, 4)
    yield root, bucketed.bucketed_tables(spark, "souk_test")
    spark.sql("DROP DATABASE souk_test CASCADE")




@pytest.mark.parametrize("name", ["top_aov_per_state", "customer_ltv", "customer_running_sales", "beat_year_max_spend"])
def test_orders_and_items_are_joined_in_place(spark, stored, name):
    report, arguments = catalog.REGISTRY[name]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = report(stored[1], **arguments)
        got = rows(df)
        p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == rows(catalog.run(name, spark, SF_SMALL))
    assert "SortMergeJoin" in p
    moved = [line for line in p.splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert moved == [], p


def test_declared_again_from_its_files(spark, stored):
    root, _ = stored
    bucketed.declare(spark, "souk_again", root, 4)
    try:
        t = bucketed.bucketed_tables(spark, "souk_again")
        assert rows(customers.customer_ltv(t)) == rows(catalog.run("customer_ltv", spark, SF_SMALL))
        spec = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED souk_again.orders").collect()}
        assert spec["Num Buckets"] == "4" and "order_id" in spec["Bucket Columns"]
    finally:
        spark.sql("DROP DATABASE souk_again CASCADE")
    with pytest.raises(ValueError):
        bucketed.declare(spark, "a b", root, 4)


def test_table_function_equals_the_report(spark, tmp_path):
    t = catalog.tables(spark, SF_SMALL)
    for name in SCHEMAS:
        getattr(t, name).write.parquet(f"{tmp_path}/{name}")
    t = read_tables(spark, str(tmp_path))
    procedures.register(spark, t)
    for a, b in [(1997, 1998), (1996, 1997), (1997, 1997), (1900, 1997)]:
        got = spark.sql(f"SELECT * FROM customers_in_both_years({a}, {b})")
        assert rows(got) == rows(customers.customers_in_both_years(t, a, b))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = spark.sql("SELECT * FROM customers_in_both_years(1996, 1998)")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p[p.index("PushedFilters"):].splitlines()[0]
    for day in ("1996-01-01", "1997-01-01", "1998-01-01", "1999-01-01"):
        assert day in pushed
    # a call is a relation like another: join it, filter it
    assert spark.sql("SELECT count(*) FROM customers_in_both_years(1997, 1998) WHERE customers_in_both_years >= 0").first()[0] == 1


def test_rollups_are_within_the_stated_error(spark):
    t = catalog.tables(spark, SF_CHECK)
    got = rollups.customer_rollups(t).collect()
    base = (t.orders.join(t.customers, "customer_id")
            .select("customer_id", "customer_state", F.date_format("order_purchase_timestamp", "yyyy-MM").alias("month")))
    exact = {}
    for i, by in enumerate([["customer_state", "month"], ["customer_state"], ["month"], []]):
        for r in base.groupBy(*by).agg(F.countDistinct("customer_id").alias("u"), F.count(F.lit(1)).alias("n")).collect():
            exact[(i, r["customer_state"] if "customer_state" in by else None, r["month"] if "month" in by else None)] = \
                (r["u"], r["n"])
    assert len(got) == len(exact)
    for r in got:
        u, n = exact[(r["grouping"], r["customer_state"], r["month"])]
        assert r["total_orders"] == n
        assert abs(r["unique_customers"] - u) <= max(1, 4 * relative_error() * u)
    # one pass over the orders serves all four groupings
    plan = rollups.customer_rollups(t)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("o_orderdate") and sum("orders.parquet" in line for line in plan.splitlines()) == 1


def test_seller_customers_against_the_exact_report(spark):
    t = catalog.tables(spark, SF_CHECK)
    exact = {r["seller_id"]: r["unique_customers"] for r in catalog.run("seller_review_rank", spark, SF_CHECK).collect()}
    got = {r["seller_id"]: r["unique_customers"] for r in rollups.seller_customers(t).collect()}
    assert set(got) == set(exact)
    assert all(abs(got[s] - n) <= max(1, 4 * relative_error() * n) for s, n in exact.items())
    assert rollups.customer_rollups(t, lg_k=6).count() > 0
