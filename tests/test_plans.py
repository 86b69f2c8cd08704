"""Plan shapes that matter at scale: no Python in any plan, anti joins stay
anti joins, per-group top-k is limited before the shuffle, global ranks are
split into segments, year filters reach the parquet scan."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from souk.functions.measures import in_year
from souk.operators.ordered import MAX_ROWS_CONF
from souk.plans import catalog
from souk.sources import read_tables
from souk.sources.tables import SCHEMAS
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(catalog.run(name, spark, SF_SMALL)) for name in catalog.REGISTRY}


def test_no_python_evaluation_anywhere(plans):
    for name, p in plans.items():
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in p, (name, node)


def test_not_exists_is_a_left_anti_join(plans):
    assert "LeftAnti" in plans["sellers_never_in_category"]


def test_per_group_topk_limits_before_shuffle(plans):
    for name in ("top_products_per_category", "top_sellers_per_category", "top_customers_per_state",
                 "best_month_per_customer", "top_aov_per_state"):
        assert "WindowGroupLimit" in plans[name], name


def test_overall_cut_is_take_ordered(plans):
    for name in ("top_customers", "priciest_products", "bottom_products", "best_month"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_global_ranks_are_segmented(spark):
    for name in ("seller_speed_rank", "seller_review_rank"):
        spark.conf.set(MAX_ROWS_CONF, "5")      # more sellers than a task may hold
        try:
            p = plan(catalog.run(name, spark, SF_SMALL))
        finally:
            spark.conf.unset(MAX_ROWS_CONF)
        assert any("Window [" in line and "_seg" in line for line in p.splitlines()), name


def test_year_filter_is_pushed_to_parquet(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, 1, dt.datetime(2017, 5, 1), None, None)]
    spark.createDataFrame(rows, SCHEMAS["orders"]).write.parquet(f"{root}/orders")
    t = read_tables(spark, root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(t.orders.where(in_year("order_purchase_timestamp", 2017)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(order_purchase_timestamp" in p
    assert "LessThan(order_purchase_timestamp" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(catalog.run("monthly_orders", spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_every_report_scans_the_supplied_tables(plans):
    for name, p in plans.items():
        assert "FileScan parquet" in p or "Scan parquet" in p, name


def test_oracle_reads_only_supplied_tables():
    from tools.oracle_check import duck

    con = duck(SF_SMALL)        # holds the supplied commerce tables alone: another name does not bind
    sql = entry.oracle_sql()
    for name in catalog.REGISTRY:
        con.execute("EXPLAIN " + sql[name])
