"""Stand-in mapping: the supplied TPC-H-like tables as commerce tables.

The supplied parquet (``customer supplier part orders lineitem nation``) has
no delivery dates, payments or reviews, so those columns are derived
deterministically from keys and dates.  Every source row is kept: each
commerce table is a projection (plus, for payments, a union) of its source,
never a subset, so work grows with the input.

Derivation rules (fixed values; the oracle SQL in ``souk.oracle`` restates
them in DuckDB syntax):

* customers: ``customer_id = c_custkey``, ``customer_state = n_name``,
  ``customer_city = n_name || '_' || c_mktsegment``
* sellers: ``seller_id = s_suppkey``, ``seller_city = n_name``
* products: ``product_id = p_partkey``; category ``p_brand || '_' || p_type``,
  NULL when ``p_size = 50``
* order_items: one per lineitem; ``price = l_extendedprice``,
  ``freight_value = l_quantity`` (both decimal(12,2))
* orders: purchase time = ``o_orderdate`` + ``(o_orderkey * 7919) % 86400``
  seconds; delivered = purchase + ``(o_orderkey * 7) % 40`` days +
  ``o_orderkey % 24`` hours, NULL when ``o_orderstatus = 'P'``; estimated =
  ``o_orderdate`` + 20 days
* order_payments: ``o_totalprice`` per order, plus a second payment of 10.00
  for orders with priority ``'1-URGENT'``
* order_reviews: one per order, ``review_id = o_orderkey``,
  ``review_score = 1 + (o_orderkey + o_custkey) % 5``,
  ``review_creation_date = o_orderdate`` + 30 days
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.sources.tables import MONEY, Tables

# Fixed values of the mapping.
NULL_CATEGORY_SIZE = 50
TIME_OF_DAY_MULTIPLIER = 7919
DELIVERY_DAY_MULTIPLIER = 7
DELIVERY_DAY_SPREAD = 40
ESTIMATE_DAYS = 20
REVIEW_DELAY_DAYS = 30
UNDELIVERED_STATUS = "P"
SURCHARGE_PRIORITY = "1-URGENT"
SURCHARGE = "10.00"


def _days(n) -> F.Column:
    return F.make_dt_interval(days=n if isinstance(n, F.Column) else F.lit(n))


def standin_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Lazy bundle: each commerce table is derived on first use."""

    def raw(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def nation() -> DataFrame:
        # nation has 25 rows by definition, whatever the scale: a proven bound.
        return F.broadcast(raw("nation").select("n_nationkey", "n_name"))

    def customers() -> DataFrame:
        return (
            raw("customer")
            .join(nation(), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.concat(F.col("n_name"), F.lit("_"), F.col("c_mktsegment")).alias("customer_city"),
                F.col("n_name").alias("customer_state"),
            )
        )

    def sellers() -> DataFrame:
        return (
            raw("supplier")
            .join(nation(), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_city"))
        )

    def products() -> DataFrame:
        return raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_size") == NULL_CATEGORY_SIZE, F.lit(None).cast("string"))
            .otherwise(F.concat(F.col("p_brand"), F.lit("_"), F.col("p_type")))
            .alias("product_category_name"),
        )

    def order_items() -> DataFrame:
        return raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_quantity").cast(MONEY).alias("freight_value"),
        )

    def orders() -> DataFrame:
        key = F.col("o_orderkey")
        purchase = F.col("o_orderdate") + F.make_dt_interval(
            secs=((key * TIME_OF_DAY_MULTIPLIER) % 86400).cast("decimal(18,6)"))
        delivered = purchase + F.make_dt_interval(
            days=((key * DELIVERY_DAY_MULTIPLIER) % DELIVERY_DAY_SPREAD).cast("int"),
            hours=(key % 24).cast("int"))
        return raw("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            purchase.alias("order_purchase_timestamp"),
            F.when(F.col("o_orderstatus") == UNDELIVERED_STATUS, F.lit(None).cast("timestamp_ntz"))
            .otherwise(delivered).alias("order_delivered_customer_date"),
            (F.col("o_orderdate") + _days(ESTIMATE_DAYS)).alias("order_estimated_delivery_date"),
        )

    def order_payments() -> DataFrame:
        o = raw("orders")
        key = F.col("o_orderkey")
        return o.select(
            key.alias("order_id"), F.col("o_totalprice").cast(MONEY).alias("payment_value")
        ).unionByName(
            o.where(F.col("o_orderpriority") == SURCHARGE_PRIORITY).select(
                key.alias("order_id"), F.lit(SURCHARGE).cast(MONEY).alias("payment_value"))
        )

    def order_reviews() -> DataFrame:
        key = F.col("o_orderkey")
        return raw("orders").select(
            key.alias("review_id"),
            key.alias("order_id"),
            (1 + (key + F.col("o_custkey")) % 5).cast("int").alias("review_score"),
            (F.col("o_orderdate") + _days(REVIEW_DELAY_DAYS)).alias("review_creation_date"),
        )

    return Tables(
        orders=orders, order_items=order_items, customers=customers, products=products,
        sellers=sellers, order_payments=order_payments, order_reviews=order_reviews,
    )
