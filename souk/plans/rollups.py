"""Customers counted from sketches: one pass over the orders, any roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.measures import month_label
from souk.operators.sketches import LG_K, estimate, rolled_up, sketch
from souk.sources import Tables


def customer_sketches(t: Tables, lg_k: int = LG_K) -> DataFrame:
    """Per (customer state, month): orders and a sketch of their customers.
    Orders are counted per customer and month before they meet the states."""
    per = (t.orders.groupBy("customer_id", month_label("order_purchase_timestamp").alias("month"))
           .agg(F.count(F.lit(1)).alias("_orders")))
    placed = per.join(t.customers.select("customer_id", "customer_state"), "customer_id")
    return sketch(placed, ["customer_state", "month"], "customer_id", "customers", lg_k, orders=F.sum("_orders"))


def customer_rollups(t: Tables, lg_k: int = LG_K) -> DataFrame:
    """Orders and (estimated) customers per state and month, per state, per
    month and in all, from one table of sketches."""
    sets = [["customer_state", "month"], ["customer_state"], ["month"], []]
    return (rolled_up(customer_sketches(t, lg_k), sets, "unique_customers", "customers", total_orders=F.sum("orders"))
            .select("grouping", "customer_state", "month", "total_orders", "unique_customers"))


def seller_customers(t: Tables, lg_k: int = LG_K) -> DataFrame:
    """(Estimated) distinct customers per seller, without a distinct shuffle."""
    pairs = (t.order_items.select("seller_id", "order_id")
             .join(t.orders.select("order_id", "customer_id"), "order_id"))
    return (sketch(pairs, ["seller_id"], "customer_id", "customers", lg_k)
            .groupBy("seller_id").agg(estimate("customers").alias("unique_customers")))
