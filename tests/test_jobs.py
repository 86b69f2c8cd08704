"""Materialised commerce parquet gives the same reports as the stand-in
view, and the scan of a year report prunes with pushed-down time filters."""

import pytest

from souk.jobs import run_report, write_tables
from souk.plans import catalog, sales
from souk.sources import read_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("commerce"))
    write_tables(catalog.tables(spark, SF_SMALL), out, files_per_table=4)
    return out


def _rows(df):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    return sorted(map(tuple, df.collect()), key=key)


@pytest.mark.parametrize("name", ["top_aov_per_state", "category_growth", "customer_running_sales",
                                  "seller_speed_rank", "zero_sales_days", "customers_in_both_years"])
def test_materialized_equals_standin(spark, root, name):
    fn, kwargs = catalog.REGISTRY[name]
    assert _rows(fn(read_tables(spark, root), **kwargs)) == _rows(catalog.run(name, spark, SF_SMALL))


def test_year_filter_pushed_on_materialized_orders(spark, root):
    t = read_tables(spark, root)
    df = sales.category_growth(t, 1997, 1998)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(order_purchase_timestamp,1997-01-01T00:00)" in plan
    assert "LessThan(order_purchase_timestamp,1999-01-01T00:00)" in plan or \
        "LessThan(order_purchase_timestamp,1998-01-01T00:00)" in plan


def test_run_report_writes_parquet(spark, root, tmp_path):
    out = str(tmp_path / "aov")
    run_report(spark, "top_aov_per_state", out, tables=root)
    assert spark.read.parquet(out).count() == catalog.run("top_aov_per_state", spark, SF_SMALL).count()


def test_cli_materialize_and_report(spark, tmp_path):
    from souk.jobs import main
    out = str(tmp_path / "tables")
    main(["materialize", "--sf-dir", SF_SMALL, "--out", out, "--files", "2"])
    assert spark.read.parquet(f"{out}/orders").count() == catalog.tables(spark, SF_SMALL).orders.count()
    rep = str(tmp_path / "monthly")
    main(["report", "--tables", out, "--name", "monthly_orders", "--out", rep])
    assert spark.read.parquet(rep).count() == catalog.run("monthly_orders", spark, SF_SMALL).count()
