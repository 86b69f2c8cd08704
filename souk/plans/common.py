"""Shared building blocks of the reports.

``order_totals`` aggregates items per order *before* they meet the orders
table.  ``order_id`` is the key of ``orders``, so joining per-order totals is
the same as joining every item and aggregating afterwards, but:

* the item table (the largest) is reduced map-side to one row per order and
  task before its shuffle, so an order holding a large share of all items is
  no hot key in any later join;
* the join input shrinks by the number of items per order, and the
  aggregated side is already partitioned by ``order_id``, so only ``orders``
  is shuffled for the join;
* ``count(DISTINCT order_id)`` over the joined items becomes a plain
  ``count(*)`` over per-order rows (no distinct-aggregate expansion).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.functions.measures import item_value
from souk.sources import Tables


def item_totals(t: Tables, *keys: str) -> DataFrame:
    """Per ``(order_id, *keys)``: item value, freight and item count."""
    return t.order_items.groupBy("order_id", *keys).agg(
        F.sum(item_value()).alias("order_value"),
        F.sum("freight_value").alias("order_freight"),
        F.count(F.lit(1)).alias("order_items"))


def order_totals(t: Tables, *keys: str, order_cols: tuple[str, ...] = (
        "customer_id", "order_purchase_timestamp")) -> DataFrame:
    """Per-order item totals joined to the order's own columns (orders that
    have items only, as with an inner join of items and orders)."""
    return item_totals(t, *keys).join(t.orders.select("order_id", *order_cols), "order_id")
