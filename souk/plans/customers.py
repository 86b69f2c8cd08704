"""Customer reports: order counts, spend, lifetime value, segments, order
ranks, running totals, purchase gaps, percentile and cross-year filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.measures import (
    day_diff, decimal_ratio, in_year, in_years, int_avg, money_ratio, month_label, to_double,
)
from souk.operators import (
    above, above_percentile, asc, desc, lag_lead, rank_within, running_sum, top_k,
)
from souk.plans.common import order_totals
from souk.sources import Tables


def _order_counts(t: Tables, name: str = "order_count") -> DataFrame:
    return t.orders.groupBy("customer_id").agg(F.count("order_id").alias(name))


def repeat_customers(t: Tables, min_orders: int = 3) -> DataFrame:
    """Customers with more than ``min_orders`` orders."""
    return (_order_counts(t).where(F.col("order_count") > min_orders)
            .orderBy(F.col("order_count").desc(), "customer_id"))


def customer_segments(t: Tables, loyal_from: int = 5) -> DataFrame:
    """Order count per customer labelled one-time, loyal (``>= loyal_from``)
    or regular."""
    n = F.col("total_orders")
    return (_order_counts(t, "total_orders")
            .withColumn("customer_type",
                        F.when(n == 1, "one_time_buyer")
                        .when(n >= loyal_from, "loyal")
                        .otherwise("regular buyer"))
            .orderBy(n.desc(), "customer_id"))


def _customer_spend(t: Tables) -> DataFrame:
    # one row per order after the pre-aggregation: counting rows counts orders
    return (order_totals(t).groupBy("customer_id")
            .agg(F.sum("order_value").alias("total_spend"),
                 F.count(F.lit(1)).alias("total_orders")))


def customer_ltv(t: Tables, exact: bool = False) -> DataFrame:
    """Total spend, distinct orders and average order value (rounded to cents;
    ``exact``: decimal(18,2) and decimal(10,2) instead of doubles)."""
    cs = _customer_spend(t)
    spend, n = F.col("total_spend"), F.col("total_orders")
    return (cs.select("customer_id", (spend.cast("decimal(18,2)") if exact else to_double(spend)).alias("total_spend"),
                      "total_orders",
                      (decimal_ratio(spend, n, 10) if exact else money_ratio(spend, n)).alias("avg_order_value"))
            .orderBy(F.col("total_spend").desc()))


def top_customers(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` customers with the highest lifetime spend (customer id breaks ties)."""
    spend = order_totals(t).groupBy("customer_id").agg(F.sum("order_value").alias("lifetime_spend"))
    return (top_k(spend, [desc("lifetime_spend"), asc("customer_id")], k)
            .select("customer_id", to_double("lifetime_spend").alias("lifetime_spend")))


def top_customers_per_state(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` customers with most orders in each state (row number, id breaks ties)."""
    # count per customer first (map-side partial aggregation), then attach
    # the state: the join sees one row per customer, never a hot customer
    counts = _order_counts(t).join(t.customers.select("customer_id", "customer_state"), "customer_id")
    return top_k(counts, [desc("order_count"), asc("customer_id")], k,
                 partition=["customer_state"]).select("customer_state", "customer_id", "order_count")


def most_late_customers(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` customers with most orders delivered after the estimate."""
    late = (t.orders.where(F.col("order_delivered_customer_date")
                           > F.col("order_estimated_delivery_date"))
            .groupBy("customer_id").agg(F.count("order_id").alias("late_orders")))
    return top_k(late, [desc("late_orders"), asc("customer_id")], k)


def order_rank_per_customer(t: Tables, max_rows: int | None = None) -> DataFrame:
    """Each order's amount and its rank among the customer's orders (highest first)."""
    amounts = order_totals(t).select("order_id", "customer_id",
                                     F.col("order_value").alias("order_amount"))
    ranked = rank_within(amounts, ["customer_id"], [desc("order_amount")], "order_rank",
                         max_rows=max_rows, rows=t.rows("orders"))
    return (ranked.select("customer_id", "order_id", to_double("order_amount").alias("order_amount"),
                          "order_rank")
            .orderBy("customer_id", "order_rank"))


def order_rank_joined(t: Tables, max_rows: int | None = None) -> DataFrame:
    """As :func:`order_rank_per_customer`, through the customers table (orders
    of unknown customers drop out)."""
    amounts = (order_totals(t).join(t.customers.select("customer_id"), "customer_id")
               .select("customer_id", "order_id",
                       F.col("order_value").alias("order_purchase_amount")))
    ranked = rank_within(amounts, ["customer_id"], [desc("order_purchase_amount")], "order_rank",
                         max_rows=max_rows, rows=t.rows("orders"))
    return (ranked.select("customer_id", "order_id",
                          to_double("order_purchase_amount").alias("order_purchase_amount"),
                          "order_rank")
            .orderBy("customer_id", "order_rank"))


def customer_running_sales(t: Tables, max_rows: int | None = None) -> DataFrame:
    """Each order with the customer's cumulative sales up to it, in order of
    (purchase date, order id)."""
    sales = order_totals(t).select(
        "order_id", "customer_id",
        F.col("order_purchase_timestamp").cast("date").alias("order_date"),
        F.col("order_value").alias("order_amount"))
    run = running_sum(sales, "order_amount", ["customer_id"], [asc("order_date"), asc("order_id")],
                      "cumulative_sales", max_rows=max_rows, rows=t.rows("orders"))
    return (run.orderBy("customer_id", "order_date", "order_id")
            .select("order_id", "customer_id", to_double("cumulative_sales").alias("cumulative_sales")))


def purchase_gaps(t: Tables, max_rows: int | None = None) -> DataFrame:
    """Per order: the customer's previous order date and the days between
    (``order_id`` is the key of ``orders``, so no row repeats)."""
    details = t.orders.select(
        "customer_id", "order_id",
        F.col("order_purchase_timestamp").cast("date").alias("order_date"))
    g = lag_lead(details, "order_date", ["customer_id"], [asc("order_date"), asc("order_id")],
                 lag="previous_order_date", max_rows=max_rows, rows=t.rows("orders"))
    return (g.select("customer_id", "order_id", "order_date", "previous_order_date",
                     day_diff("previous_order_date", "order_date").alias("days_between_orders"))
            .orderBy("customer_id", "order_date", "order_id"))


def order_prev_next(t: Tables, max_rows: int | None = None) -> DataFrame:
    """Per order: the dates of the customer's previous and next order."""
    orders = t.orders.select("customer_id", "order_id",
                             F.col("order_purchase_timestamp").cast("date").alias("order_date"))
    return (lag_lead(orders, "order_date", ["customer_id"], [asc("order_date"), asc("order_id")],
                     lag="previous_order_date", lead="next_order_date", max_rows=max_rows, rows=t.rows("orders"))
            .select("customer_id", "order_id", "order_date", "previous_order_date", "next_order_date")
            .orderBy("customer_id", "order_date", "order_id"))


def avg_purchase_gap(t: Tables, max_rows: int | None = None, integer_avg: bool = True) -> DataFrame:
    """Average days between consecutive purchases per customer (truncated),
    customers with at least two orders."""
    o = t.orders.select("customer_id", "order_id", "order_purchase_timestamp")
    g = lag_lead(o, "order_purchase_timestamp", ["customer_id"],
                 [asc("order_purchase_timestamp"), asc("order_id")],
                 lag="prev_order_date", max_rows=max_rows, rows=t.rows("orders"))
    gap = day_diff("prev_order_date", "order_purchase_timestamp")
    return (g.where(F.col("prev_order_date").isNotNull())
            .groupBy("customer_id").agg(int_avg(gap, integer_avg).alias("avg_gap_days"))
            .orderBy(F.col("avg_gap_days").desc(), "customer_id"))


def customers_with_orders_left(t: Tables) -> DataFrame:
    """Every customer with each of its orders; NULL order for customers without one.

    Written as inner join + anti join rather than one LEFT JOIN: adaptive
    execution can split a skewed key only on the preserved side of an outer
    join, and the hot side here is ``orders`` (one customer may hold a large
    share of all orders).  The inner join can be split on either side, and
    the anti join's right side is reduced to distinct customers map-side."""
    cust = t.customers.select("customer_id")
    orders = t.orders.select("customer_id", "order_id")
    matched = orders.join(cust, "customer_id")
    without = (cust.join(orders.select("customer_id").distinct(), "customer_id", "left_anti")
               .select("customer_id", F.lit(None).cast(orders.schema["order_id"].dataType).alias("order_id")))
    return matched.unionByName(without).orderBy("customer_id", "order_id")


def customers_above_p90(t: Tables, p: float = 0.9, accuracy: int | None = None) -> DataFrame:
    """Customers whose order count is above the ``p`` percentile of order counts."""
    return (above_percentile(_order_counts(t), "order_count", p, accuracy, rows=t.rows("customers"))
            .orderBy(F.col("order_count").desc(), "customer_id"))


def beat_year_max_spend(t: Tables, year: int = 2017) -> DataFrame:
    """Customers whose all-time payments exceed the largest total any customer
    paid for orders placed in ``year``.

    Payments are summed per order, joined to orders and customers, and each
    customer gets its all-time and its ``year`` total in one array, which
    both sides of the theta join read: the joins below run once."""
    per_order = t.order_payments.groupBy("order_id").agg(F.sum("payment_value").alias("_paid"))
    in_y = in_year("order_purchase_timestamp", year)
    per = (per_order.join(t.orders.select("order_id", "customer_id", "order_purchase_timestamp"),
                          "order_id")
           .groupBy("customer_id").agg(F.array(F.sum("_paid"), F.sum(F.when(in_y, F.col("_paid")))).alias("_spent"))
           # customers is keyed by customer_id: an inner join keeps known customers
           .join(t.customers.select("customer_id"), "customer_id"))
    total, in_year_total = F.col("_spent")[0], F.col("_spent")[1]
    return (above(per, total, F.max(in_year_total))
            .select("customer_id", to_double(total).alias("total_spent"))
            .orderBy(F.col("total_spent").desc()))


def customers_in_both_years(t: Tables, year1: int = 2017, year2: int = 2018) -> DataFrame:
    """Number of customers with orders in both years (one row).

    An intersection by aggregation: one pass per customer flags each year,
    then a global count; both stages aggregate map-side first."""
    ts = F.col("order_purchase_timestamp")
    y = F.year(ts)
    per = (t.orders.where(in_years(ts, [year1, year2]))
           .groupBy("customer_id")
           .agg(F.max((y == year1).cast("int")).alias("_a"), F.max((y == year2).cast("int")).alias("_b")))
    both = per.where((F.col("_a") == 1) & (F.col("_b") == 1) & F.lit(year1 != year2))
    return both.agg(F.count(F.lit(1)).alias("customers_in_both_years"))


def top_aov_per_state(t: Tables, k: int = 3) -> DataFrame:
    """Customers ranked by average order value within their state, rank <= k."""
    per = (order_totals(t).groupBy("customer_id")
           .agg(F.sum("order_value").alias("_v"), F.count(F.lit(1)).alias("_n")))
    aov = (per.join(t.customers.select("customer_id", "customer_state"), "customer_id")
           .select("customer_id", "customer_state",
                   (F.col("_v").cast("double") / F.col("_n")).alias("aov")))
    return (top_k(aov, [desc("aov")], k, partition=["customer_state"], ties="rank",
                  rank_col="state_rank")
            .orderBy("customer_state", "state_rank"))


def best_month_per_customer(t: Tables) -> DataFrame:
    """Each customer's month(s) of highest spending (ties kept)."""
    m = (order_totals(t)
         .groupBy("customer_id", month_label("order_purchase_timestamp").alias("order_month"))
         .agg(F.sum("order_value").alias("sales")))
    return (top_k(m, [desc("sales")], 1, partition=["customer_id"], ties="rank")
            .select("customer_id", "order_month", to_double("sales").alias("sales"))
            .orderBy("customer_id"))


def state_sales_profile(t: Tables) -> DataFrame:
    """Per customer state: sales, distinct orders and average freight per item."""
    per = (order_totals(t).groupBy("customer_id")
           .agg(F.sum("order_value").alias("_v"), F.count(F.lit(1)).alias("_orders"),
                F.sum("order_freight").alias("_f"), F.sum("order_items").alias("_items")))
    return (per.join(t.customers.select("customer_id", "customer_state"), "customer_id")
            .groupBy("customer_state")
            .agg(to_double(F.sum("_v")).alias("total_sales"),
                 F.sum("_orders").alias("total_orders"),
                 (F.sum("_f").cast("double") / F.sum("_items")).alias("avg_freight_cost"))
            .orderBy(F.col("total_sales").desc()))
