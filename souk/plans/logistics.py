"""Logistics, payment and review reports: delivery times, late deliveries,
percentiles, order/city joins, freight, payments and review scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.measures import day_diff, decimal_ratio, round_half_up_ratio, to_double, trunc_avg
from souk.operators import asc, desc, equal_to_max, top_k
from souk.operators.threshold import percentile_cont, percentile_of
from souk.plans.common import order_totals
from souk.sources import Tables

DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"


def _delivery_days() -> F.Column:
    return day_diff("order_purchase_timestamp", "order_delivered_customer_date")


def _state_delivery(t: Tables, name: str, integer_avg: bool) -> DataFrame:
    """Average delivery days per state (truncated: ``integer_avg``).  Days are summed and
    counted per customer first (map-side partial aggregation), so the join
    with customers sees one row per customer; the state average is the exact
    sum / count of the per-order values, as ``avg`` over orders would be."""
    per = (t.orders.where(F.col(DELIVERED).isNotNull())
           .groupBy("customer_id")
           .agg(F.sum(_delivery_days()).alias("_days"), F.count(_delivery_days()).alias("_n")))
    mean = F.sum("_days").cast("double") / F.sum("_n")
    return (per.join(t.customers.select("customer_id", "customer_state"), "customer_id")
            .groupBy("customer_state").agg((mean.cast("int") if integer_avg else mean).alias(name)))


def delivery_days_by_state(t: Tables, integer_avg: bool = True) -> DataFrame:
    """Average (truncated) delivery days per customer state, delivered orders."""
    return _state_delivery(t, "avg_del_days", integer_avg).orderBy(F.col("avg_del_days").desc())


def slowest_states(t: Tables, k: int = 5, integer_avg: bool = True) -> DataFrame:
    """The ``k`` states with the highest average (truncated) delivery days."""
    return top_k(_state_delivery(t, "avg_delivery_days", integer_avg),
                 [desc("avg_delivery_days"), asc("customer_state")], k)


def late_pct(t: Tables, exact: bool = False) -> DataFrame:
    """Share of delivered orders that arrived after the estimate, in percent,
    rounded half-up to two decimals (one row; ``exact``: decimal(5,2))."""
    late = F.when(F.col(ESTIMATED) < F.col(DELIVERED), 1).otherwise(0)
    agg = t.orders.where(F.col(DELIVERED).isNotNull()).agg(
        F.sum(late).alias("_late"), F.count(F.lit(1)).alias("_n"))
    hundred = F.col("_late") * 100
    pct = (decimal_ratio(hundred.cast("decimal(22,0)"), F.col("_n"), 5) if exact
           else round_half_up_ratio(hundred, F.col("_n")))
    return agg.select(pct.alias("perc_late_del"))


def late_pct_per_year(t: Tables) -> DataFrame:
    """Late-delivery percentage per purchase year (orders with both dates)."""
    late = F.count(F.when(F.col(DELIVERED) > F.col(ESTIMATED), 1))
    return (t.orders.where(F.col(DELIVERED).isNotNull() & F.col(ESTIMATED).isNotNull())
            .groupBy(F.year("order_purchase_timestamp").alias("order_year"))
            .agg(((late * 100).cast("double") / F.count(F.lit(1))).alias("late_delivery_percentage"))
            .orderBy("order_year"))


def category_p90_delivery(t: Tables, p: float = 0.9, min_days: float = 10,
                          accuracy: int | None = None) -> DataFrame:
    """Categories whose ``p`` percentile of delivery days exceeds ``min_days``.

    Items are counted per (product, days) before they meet ``products``; the
    percentile is selected from the counts per (category, days)
    (``accuracy`` opts into the approximate sketch, item by item)."""
    days = (t.orders.where(F.col(DELIVERED).isNotNull())
            .join(t.order_items.select("order_id", "product_id"), "order_id")
            .select("product_id", _delivery_days().alias("_days")))
    if accuracy:
        g = (days.join(t.products, "product_id").groupBy("product_category_name")
             .agg(percentile_of("_days", p, accuracy).alias("percentile")))
    else:
        counted = days.groupBy("product_id", "_days").agg(F.count(F.lit(1)).alias("_n")).join(t.products, "product_id")
        g = percentile_cont(counted, "_days", p, ["product_category_name"], weight="_n")
    return (g.where(F.col("percentile") > min_days)
            .select("product_category_name", F.round("percentile", 6).alias("p90_delivery_days"))
            .orderBy(F.col("p90_delivery_days").desc()))


def order_city_pairs(t: Tables) -> DataFrame:
    """Per order item: order id, customer city and seller city."""
    return (t.orders.select("order_id", "customer_id")
            .join(t.customers.select("customer_id", "customer_city"), "customer_id")
            .join(t.order_items.select("order_id", "seller_id"), "order_id")
            .join(t.sellers.select("seller_id", "seller_city"), "seller_id")
            .select("order_id", "customer_city", "seller_city")
            .orderBy("order_id"))


def order_freight(t: Tables) -> DataFrame:
    """Total freight per order (orders that have items)."""
    return (order_totals(t, order_cols=())
            .select("order_id", to_double("order_freight").alias("total_freight"))
            .orderBy("order_id"))


def max_payment_orders(t: Tables) -> DataFrame:
    """Order(s) whose payment total equals the largest payment total."""
    totals = t.order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("total_payment"))
    return (equal_to_max(totals, "total_payment")
            .select("order_id", to_double("total_payment").alias("total_payment")))


def _product_reviews(t: Tables) -> DataFrame:
    return t.order_items.select("order_id", "product_id").join(
        t.order_reviews.select("order_id", "review_id", "review_score"), "order_id")


def product_review_avg(t: Tables, min_reviews: int = 20) -> DataFrame:
    """Average review score per product over item x review rows, products with
    at least ``min_reviews`` such rows."""
    return (_product_reviews(t).groupBy("product_id")
            .agg(F.avg(F.col("review_score").cast("double")).alias("avg_review_score"),
                 F.count("review_id").alias("review_count"))
            .where(F.col("review_count") >= min_reviews)
            .orderBy(F.col("avg_review_score").desc()))


def best_rated_products(t: Tables, k: int = 10) -> DataFrame:
    """The ``k`` products with the best average review score (no minimum count)."""
    avg = (_product_reviews(t).groupBy("product_id")
           .agg(F.avg(F.col("review_score").cast("double")).alias("avg_score")))
    return top_k(avg, [desc("avg_score"), asc("product_id")], k)


def lowest_rated_months(t: Tables, integer_avg: bool = False) -> DataFrame:
    """Month(s) with the lowest average review score (ties kept; scores are
    averaged exactly unless ``integer_avg`` truncates)."""
    d = F.col("review_creation_date")
    m = (t.order_reviews.groupBy(F.year(d).alias("review_year"), F.month(d).alias("review_month"))
         .agg((trunc_avg("review_score") if integer_avg else F.avg(F.col("review_score").cast("double")))
              .alias("avg_review_score")))
    return top_k(m, [asc("avg_review_score")], 1, ties="rank")
