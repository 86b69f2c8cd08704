"""Seller reports: delays, first/last orders, category coverage, revenue and
order-count thresholds, speed and review rankings, monthly drops."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.measures import day_diff, int_avg, item_value, month_label, to_double
from souk.operators import above_mean, above_percentile, asc, desc, rank_by_key, top_k
from souk.sources import Tables


def worst_delay_seller(t: Tables, integer_avg: bool = True) -> DataFrame:
    """The seller with the highest average (truncated) days between estimated
    and actual delivery, weighted by items."""
    delays = (t.orders.where(F.col("order_delivered_customer_date").isNotNull())
              .join(t.order_items, "order_id")
              .groupBy("seller_id")
              .agg(int_avg(day_diff("order_estimated_delivery_date", "order_delivered_customer_date"),
                           integer_avg).alias("avg_delay")))
    return top_k(delays, [desc("avg_delay"), asc("seller_id")], 1)


def seller_first_last_order(t: Tables) -> DataFrame:
    """First and last purchase time of each seller's items (items LEFT JOIN orders)."""
    ts = F.col("order_purchase_timestamp")
    return (t.order_items.select("seller_id", "order_id")
            .join(t.orders.select("order_id", "order_purchase_timestamp"), "order_id", "left")
            .groupBy("seller_id")
            .agg(F.min(ts).alias("first_order_date"), F.max(ts).alias("last_order_date")))


def sellers_unmatched_left_join(t: Tables, category: str = "eletrodomesticos") -> DataFrame:
    """Sellers with no items, or with at least one item outside ``category``
    (the literal outcome of LEFT JOIN ... AND category = x WHERE product IS NULL)."""
    in_cat = t.products.where(F.col("product_category_name") == category) \
        .select(F.col("product_id").alias("_pid"))
    # item rows meet the (small) set of products in the category directly:
    # broadcast when it fits, and only the matching side is reduced after
    items = t.order_items.select("seller_id", "product_id")
    # One pass over the items: per seller, does any of them miss the category?
    # (Partial aggregation map-side, so a large seller is no hot key.)
    missed = (items.join(in_cat, F.col("product_id") == F.col("_pid"), "left")
              .groupBy("seller_id").agg(F.max(F.col("_pid").isNull()).alias("_missed")))
    return (t.sellers.select("seller_id").join(missed, "seller_id", "left")
            .where(F.coalesce("_missed", F.lit(True))).select("seller_id").distinct())


def sellers_never_in_category(t: Tables, category: str = "eletrodomesticos") -> DataFrame:
    """Sellers without any item in ``category`` (NOT EXISTS, a left anti join)."""
    # the category filter cuts the item rows before any per-seller work
    sold = (t.order_items.select("seller_id", "product_id")
            .join(t.products.where(F.col("product_category_name") == category).select("product_id"),
                  "product_id")
            .select("seller_id").distinct())
    return t.sellers.select("seller_id").join(sold, "seller_id", "left_anti")


def _seller_revenue(t: Tables) -> DataFrame:
    return t.order_items.groupBy("seller_id").agg(F.sum(item_value()).alias("total_revenue"))


def sellers_above_avg_revenue(t: Tables) -> DataFrame:
    """Sellers whose revenue exceeds the mean revenue per seller."""
    return (above_mean(_seller_revenue(t), "total_revenue")
            .select("seller_id", to_double("total_revenue").alias("total_revenue")))


def sellers_above_median_orders(t: Tables) -> DataFrame:
    """Sellers whose item-row count is above the median item-row count
    (one row per seller)."""
    counts = t.order_items.groupBy("seller_id").agg(F.count("order_id").alias("total_orders"))
    return above_percentile(counts, "total_orders", 0.5, rows=t.rows("sellers"))


def seller_speed_rank(t: Tables, max_rows: int | None = None, integer_avg: bool = True) -> DataFrame:
    """Average (truncated) delivery days per seller and a global rank, fastest
    first; sellers without deliveries have a NULL average and rank first.

    A global rank without a cut: computed from key counts (few distinct
    averages, many ties) with the segmented running sum, never on one task."""
    speed = (t.orders.join(t.order_items, "order_id").groupBy("seller_id")
             .agg(int_avg(day_diff("order_purchase_timestamp", "order_delivered_customer_date"),
                          integer_avg).alias("avg_diff")))
    return (rank_by_key(speed, [], [asc("avg_diff")], "speed_rank", max_rows=max_rows, rows=t.rows("sellers"))
            .select("seller_id", "avg_diff", "speed_rank")
            .orderBy("speed_rank", "seller_id"))


def seller_review_rank(t: Tables, max_rows: int | None = None) -> DataFrame:
    """Average review score and distinct customers per seller, ranked by
    score then customers (both descending), over all sellers at once."""
    stats = (t.order_items.select("seller_id", "order_id")
             .join(t.orders.select("order_id", "customer_id"), "order_id")
             .join(t.order_reviews.select("order_id", "review_score"), "order_id")
             .groupBy("seller_id")
             .agg(F.avg(F.col("review_score").cast("double")).alias("avg_review_score"),
                  F.countDistinct("customer_id").alias("unique_customers")))
    return (rank_by_key(stats, [], [desc("avg_review_score"), desc("unique_customers")],
                        "seller_rank", max_rows=max_rows, rows=t.rows("sellers"))
            .select("seller_id", "avg_review_score", "unique_customers", "seller_rank")
            .orderBy("seller_rank"))


def seller_monthly_drop(t: Tables, drop: float = 0.3) -> DataFrame:
    """Seller sales per month, the previous month with sales, and a flag when
    sales fell below ``1 - drop`` of it.

    A seller has at most one row per month: window partitions are bounded by
    the calendar span."""
    m = (t.order_items.join(t.orders, "order_id")
         .groupBy("seller_id", month_label("order_purchase_timestamp").alias("sale_month"))
         .agg(F.sum(item_value()).alias("sales")))
    prev = F.lag("sales").over(Window.partitionBy("seller_id").orderBy("sale_month"))
    keep = F.lit(Decimal(str(round(1 - drop, 6))))
    m = m.withColumn("prev_month_sales", prev)
    flag = F.when(F.col("prev_month_sales").isNotNull()
                  & (F.col("sales") < F.col("prev_month_sales") * keep), 1).otherwise(0)
    return (m.select("seller_id", "sale_month", to_double("sales").alias("sales"),
                     to_double("prev_month_sales").alias("prev_month_sales"),
                     flag.alias("sales_dropped_flag"))
            .orderBy("seller_id", "sale_month"))
