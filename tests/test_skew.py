"""Reports over a deliberately skewed bundle: customer 0 holds a third of all
orders.  With a small ``max_rows`` the hot customer (and the global ranks) are
split into many segments; the answers must equal the unsplit ones."""

import pytest
from pyspark.sql import functions as F

from souk.operators.ordered import asc, segments
from souk.plans import catalog, customers, sellers
from souk.sources import Tables
from tests.conftest import SF_SMALL

SMALL, HUGE = 20, 10**12


@pytest.fixture(scope="module")
def skewed(spark):
    base = catalog.tables(spark, SF_SMALL)
    hot = F.when(F.col("order_id") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col("customer_id"))
    return Tables.of(
        orders=base.orders.withColumn("customer_id", hot),
        order_items=base.order_items, customers=base.customers, products=base.products,
        sellers=base.sellers, order_payments=base.order_payments, order_reviews=base.order_reviews)


def _rows(df):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    return sorted(map(tuple, df.collect()), key=key)


def test_hot_customer_is_split(skewed):
    s = segments(skewed.orders, ["customer_id"], asc("order_purchase_timestamp"), max_rows=SMALL)
    n_hot = s.where(F.col("customer_id") == 0).select("_seg").distinct().count()
    n_rows = skewed.orders.where(F.col("customer_id") == 0).count()
    assert n_rows > SMALL * 5
    assert n_hot >= n_rows // SMALL


@pytest.mark.parametrize("report", [
    customers.order_rank_per_customer, customers.order_rank_joined,
    customers.customer_running_sales, customers.purchase_gaps, customers.avg_purchase_gap,
    sellers.seller_speed_rank, sellers.seller_review_rank,
])
def test_split_equals_unsplit(skewed, report):
    assert _rows(report(skewed, max_rows=SMALL)) == _rows(report(skewed, max_rows=HUGE))


def test_hot_customer_spreads_over_shuffle_partitions(skewed):
    from souk.operators.ordered import GK, SEG
    s = segments(skewed.orders, ["customer_id"], [asc("order_purchase_timestamp"), asc("order_id")],
                 max_rows=SMALL)
    # the window exchange hashes on (group key, segment): the hot customer's
    # rows land in many partitions instead of one
    placed = s.repartition(8, GK, SEG).where(F.col("customer_id") == 0) \
        .select(F.spark_partition_id().alias("p")).distinct().count()
    assert placed >= 4
