"""Hand-made frames for the cases the supplied tables never reach: NULL
deliveries and categories, customers without orders, unsold products and
idle sellers, ties at a cut, midnight crossings, empty input."""

import datetime as dt
from decimal import Decimal as D

import pytest

from souk.plans import customers, logistics, sales, sellers
from souk.sources import Tables


def ts(*a):
    return dt.datetime(*a)


@pytest.fixture(scope="module")
def t(spark):
    return Tables.from_rows(
        spark,
        customers=[(1, "A", "SP"), (2, "B", "RJ"), (3, "C", "SP")],
        sellers=[(1, "X"), (2, "Y"), (3, "Z"), (4, "W")],
        products=[(1, "eletro"), (2, "moveis"), (3, None), (4, "moveis")],
        orders=[
            (1, 1, ts(2017, 1, 10, 23, 59), ts(2017, 1, 12, 0, 1), ts(2017, 1, 11)),
            (2, 1, ts(2017, 2, 1, 10), None, ts(2017, 2, 20)),
            (3, 2, ts(2018, 3, 5, 8), ts(2018, 3, 6, 7), ts(2018, 3, 10)),
            (4, 2, ts(2018, 3, 5, 9), ts(2018, 3, 8), ts(2018, 3, 7)),
        ],
        order_items=[
            (1, 1, 1, D("100.00"), D("10.00")),
            (1, 2, 2, D("50.00"), D("5.00")),
            (2, 2, 1, D("20.00"), D("2.00")),
            (2, 2, 4, D("10.00"), D("1.00")),
            (3, 3, 2, D("30.00"), D("3.00")),
            (4, 1, 2, D("100.00"), D("10.00")),
        ],
        order_payments=[(1, D("165.00")), (2, D("33.00")), (3, D("33.00")),
                        (4, D("100.00")), (4, D("10.00"))],
        order_reviews=[(1, 1, 5, ts(2017, 1, 20)), (3, 3, 1, ts(2018, 3, 20)),
                       (4, 4, 3, ts(2018, 3, 21))],
    )


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def rows(df, *cols):
    src = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in src.collect()), key=_key)


def test_delivery_days_cross_midnight_and_skip_undelivered(t):
    # order 1: 23:59 -> 00:01 two days later = 2 boundaries; order 2 undelivered
    assert rows(logistics.delivery_days_by_state(t)) == [("RJ", 2), ("SP", 2)]


def test_late_pct_rounds_half_up(t):
    assert logistics.late_pct(t).collect()[0][0] == 66.67


def test_late_pct_on_empty_input_is_one_null_row(spark):
    empty = Tables.from_rows(spark)
    assert [tuple(r) for r in logistics.late_pct(empty).collect()] == [(None,)]


def test_customers_without_orders_keep_a_null_order(t):
    got = rows(customers.customers_with_orders_left(t))
    assert (3, None) in got and len(got) == 5


def test_unsold_product_counts_zero_and_null_category_is_a_group(t):
    got = dict((r[0], (r[1], r[2])) for r in sales.product_order_counts(t).collect())
    assert got[4] == ("moveis", 0)
    assert got[3] == (None, 1)


def test_anti_join_vs_literal_left_join(t):
    never = {r[0] for r in sellers.sellers_never_in_category(t, "eletro").collect()}
    unmatched = {r[0] for r in sellers.sellers_unmatched_left_join(t, "eletro").collect()}
    assert never == {3, 4}
    assert unmatched == {1, 2, 3, 4}
    assert never <= unmatched


def test_seller_speed_rank_null_first_and_ties_share_rank(t):
    got = rows(sellers.seller_speed_rank(t, max_rows=1))
    assert got == [(1, 2, 2), (2, 2, 2), (4, None, 1)]
    # same answer without forced segments
    assert rows(sellers.seller_speed_rank(t)) == got


def test_customer_ltv_aov_in_cents(t):
    got = rows(customers.customer_ltv(t))
    assert got == [(1, 198.0, 2, 99.0), (2, 143.0, 2, 71.5)]


def test_both_years(t):
    assert customers.customers_in_both_years(t, 2017, 2018).first()[0] == 0
    assert customers.customers_in_both_years(t, 2017, 2017).first()[0] == 0


def test_purchase_gaps_tie_broken_by_order_id(t):
    got = rows(customers.purchase_gaps(t, max_rows=1))
    assert got == [
        (1, 1, dt.date(2017, 1, 10), None, None),
        (1, 2, dt.date(2017, 2, 1), dt.date(2017, 1, 10), 22),
        (2, 3, dt.date(2018, 3, 5), None, None),
        (2, 4, dt.date(2018, 3, 5), dt.date(2018, 3, 5), 0),
    ]
    assert rows(customers.avg_purchase_gap(t, max_rows=1)) == [(1, 22), (2, 0)]


def test_zero_sales_days(t):
    days = [r[0] for r in sales.zero_sales_days(t).collect()]
    span = (dt.date(2018, 3, 5) - dt.date(2017, 1, 10)).days + 1
    assert len(days) == span - 3
    assert dt.date(2017, 1, 11) in days and dt.date(2017, 2, 1) not in days


def test_rank_cut_keeps_ties_and_row_cut_breaks_them_by_id(t):
    # products 1 and 2 both sell 220.00 / 88.00 ... rank ties are kept
    ranked = rows(sales.top_products_rank(t, k=1))
    assert ranked == [(1, 220.0, 1)]
    cut = rows(customers.top_customers(t, k=1))
    assert cut == [(1, 198.0)]


def test_beat_year_max_spend_theta_join(t):
    # best 2017 customer paid 198.00; customer 2 paid 143.00 in total
    assert rows(customers.beat_year_max_spend(t, 2017)) == []
    assert rows(customers.beat_year_max_spend(t, 2018)) == [(1, 198.0)]


def test_monthly_drop_flag(t):
    got = rows(sellers.seller_monthly_drop(t))
    # seller 1: 2017-01 110.00 then 2017-02 22.00 (< 70%) -> flagged
    assert (1, "2017-02", 22.0, 110.0, 1) in got
    assert (1, "2017-01", 110.0, None, 0) in got


def test_record_months_first_month_counts(t):
    got = rows(sales.record_months(t))
    assert ("moveis", "2017-01", 55.0) in got
    assert ("moveis", "2017-02", 33.0) not in got


def test_lowest_rated_month_ties_kept(t):
    got = rows(logistics.lowest_rated_months(t))
    assert got == [(2018, 3, 2.0)]


def test_category_growth_zero_for_missing_year(t):
    got = {r[0]: tuple(r[1:]) for r in sales.category_growth(t, 2017, 2018).collect()}
    assert got["eletro"] == (110.0, 110.0, 0.0)
    assert got["moveis"] == (88.0, 0.0, -88.0)
    assert got[None] == (0.0, 33.0, 33.0)


def test_approximate_percentile_is_opt_in(spark):
    from souk.plans import catalog
    from tests.conftest import SF_SMALL
    t = catalog.tables(spark, SF_SMALL)
    exact = {r[0] for r in customers.customers_above_p90(t).collect()}
    approx = {r[0] for r in customers.customers_above_p90(t, accuracy=100000).collect()}
    assert exact and approx
    # the approximate p90 is an input value at most one rank step away
    assert exact <= approx or approx <= exact
    cats = logistics.category_p90_delivery(t, accuracy=100000).count()
    assert cats == logistics.category_p90_delivery(t).count()


def test_moving_average_rows_vs_calendar_days(t):
    rows_mode = {(r[0], r[1]): r[3] for r in sales.moving_avg_category(t).collect()}
    cal_mode = {(r[0], r[1]): r[3] for r in sales.moving_avg_category(t, calendar=True).collect()}
    feb = ("moveis", dt.date(2017, 2, 1))
    assert rows_mode[feb] == 44.0        # (55.00 + 33.00) / 2: previous row counts
    assert cal_mode[feb] == 33.0         # previous sale is 22 days earlier
