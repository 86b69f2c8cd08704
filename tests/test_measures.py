"""Central semantic decisions: day boundaries, month labels, year ranges,
half-up rounding in integers, truncated integer averages."""

import datetime as dt

from pyspark.sql import functions as F

from souk.functions.measures import (
    day_diff, decimal_ratio, in_year, month_label, round_half_up_ratio, trunc_avg,
)


def test_day_diff_counts_midnights(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2017, 3, 4, 23, 59), dt.datetime(2017, 3, 5, 0, 1)),
         (dt.datetime(2017, 3, 4, 0, 1), dt.datetime(2017, 3, 4, 23, 59)),
         (dt.datetime(2017, 3, 5, 0, 1), dt.datetime(2017, 3, 4, 23, 59))],
        "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(day_diff("a", "b")).collect()] == [1, 0, -1]


def test_month_label_is_year_month(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 3, 4, 5, 6, 7),)], "ts timestamp_ntz")
    assert df.select(month_label("ts")).first()[0] == "2017-03"


def test_in_year_is_half_open(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2016, 12, 31, 23, 59, 59),), (dt.datetime(2017, 1, 1),),
         (dt.datetime(2017, 12, 31, 23, 59, 59),), (dt.datetime(2018, 1, 1),)], "ts timestamp_ntz")
    assert df.where(in_year("ts", 2017)).count() == 2


def test_round_half_up_ratio(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (5, 2), (0, 7), (10**15 + 1, 2)], "a long, n long")
    got = [r[0] for r in df.select(round_half_up_ratio(F.col("a"), F.col("n"))).collect()]
    assert got == [0.13, 0.33, 0.67, 2.5, 0.0, 500000000000000.5]


def test_trunc_avg_toward_zero(spark):
    df = spark.createDataFrame([(1, -1), (1, -2), (2, 1), (2, 2)], "g int, v int")
    got = dict(df.groupBy("g").agg(trunc_avg("v")).collect())
    assert got == {1: -1, 2: 1}


def test_decimal_ratio_is_exact(spark):
    import decimal
    from decimal import ROUND_HALF_UP, Decimal

    ctx = decimal.Context(prec=90)
    cases = [("0.05", 2), ("0.01", 2), ("-0.01", 2), ("10.00", 3), ("0.00", 7), ("90071992547409.93", 1),
             ("123456789012345678901234567890123.45", 7), ("-999999999999999999999999999999999.99", 999999999999),
             ("100000000000000000000000000000000.01", 9223372036854775807), ("0.04", 8), ("1.00", 3), ("2.00", 3)]
    df = spark.createDataFrame([(Decimal(a), n) for a, n in cases], "a decimal(38,2), n long")
    got = df.select(decimal_ratio(F.col("a"), F.col("n"), 38))
    assert got.schema[0].dataType.simpleString() == "decimal(38,2)"
    assert [r[0] for r in got.collect()] == [
        ctx.divide(Decimal(a), Decimal(n)).quantize(Decimal("0.01"), ROUND_HALF_UP, ctx) for a, n in cases]
    odd = spark.createDataFrame([(Decimal("1.00"), 0), (None, 3), (Decimal("1.00"), None)], "a decimal(12,2), n long")
    assert [r[0] for r in odd.select(decimal_ratio(F.col("a"), F.col("n"), 10)).collect()] == [None] * 3


def test_decimal_reports_hold_no_double(spark):
    from souk.plans import catalog
    from tests.conftest import SF_SMALL

    want = {"late_pct_decimal": {"perc_late_del": "decimal(5,2)"},
            "customer_ltv_decimal": {"total_spend": "decimal(18,2)", "avg_order_value": "decimal(10,2)"},
            "moving_avg_category_decimal": {"daily_sales": "decimal(18,2)", "moving_avg_3day": "decimal(18,2)"}}
    for name, kinds in want.items():
        df = catalog.run(name, spark, SF_SMALL)
        assert {c: t for c, t in df.dtypes if c in kinds} == kinds
        plan = df._jdf.queryExecution().analyzed().toString()
        report = plan[:plan.index("Relation")] if "Relation" in plan else plan
        assert "as double" not in report.split("l_extendedprice")[0], name


def test_integer_average_switch(spark):
    from souk.plans import catalog, customers, logistics, sellers
    from tests.conftest import SF_SMALL

    t = catalog.tables(spark, SF_SMALL)
    pairs = [(logistics.delivery_days_by_state, "customer_state", "avg_del_days"),
             (customers.avg_purchase_gap, "customer_id", "avg_gap_days"),
             (sellers.seller_speed_rank, "seller_id", "avg_diff")]
    for report, key, value in pairs:
        cut = {r[key]: r[value] for r in report(t).collect()}
        full = {r[key]: r[value] for r in report(t, integer_avg=False).collect()}
        assert cut == {k: int(v) for k, v in full.items()}
        assert len(set(full.values())) > len(set(cut.values()))
    assert logistics.lowest_rated_months(t, integer_avg=True).count() >= logistics.lowest_rated_months(t).count()
