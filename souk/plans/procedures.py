"""Parametrised SQL: the stored-procedure questions.

``customers_in_both_years_sql`` runs a fixed statement through ``spark.sql``
with named parameter markers and a DataFrame argument.  ``register`` declares
the same as a SQL table function with typed parameters over the tables as
session views, so that a user can write
``SELECT * FROM customers_in_both_years(2016, 2017)``.  Either way arguments
are bound by the analyzer (no string formatting of values) and the year ranges
reach the scan of ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.sources import SCHEMAS, Tables

# A year is a range of purchase times, which the scan of ``orders`` prunes by.
_YEAR = """(order_purchase_timestamp >= make_timestamp_ntz({0}, 1, 1, 0, 0, 0)
            AND order_purchase_timestamp < make_timestamp_ntz({0} + 1, 1, 1, 0, 0, 0))"""


def _both_years(year1: str, year2: str, orders: str) -> str:
    first, second = _YEAR.format(year1), _YEAR.format(year2)
    return f"""
WITH flagged AS (
  SELECT customer_id, {first} AS a, {second} AND {year1} <> {year2} AS b
  FROM {orders}
  WHERE {first} OR {second}
), active AS (
  SELECT bool_or(a) AND bool_or(b) AS in_both FROM flagged GROUP BY customer_id
)
SELECT count_if(in_both) AS customers_in_both_years FROM active
"""


CUSTOMERS_IN_BOTH_YEARS = _both_years(":year1", ":year2", "{orders}")


def customers_in_both_years_sql(t: Tables, year1: int = 2017, year2: int = 2016) -> DataFrame:
    """The procedure called with (``year1``, ``year2``)."""
    orders = t.orders
    return orders.sparkSession.sql(CUSTOMERS_IN_BOTH_YEARS,
                                   args={"year1": year1, "year2": year2}, orders=orders)


def register(spark: SparkSession, t: Tables, prefix: str = "souk_") -> None:
    """Declare every table of ``t`` as the session view ``<prefix><table>`` and
    the table function ``customers_in_both_years(year1 INT, year2 INT)``."""
    for name in SCHEMAS:
        getattr(t, name).createOrReplaceTempView(prefix + name)
    body = _both_years("customers_in_both_years.year1", "customers_in_both_years.year2", prefix + "orders")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION customers_in_both_years(year1 INT, year2 INT)
RETURNS TABLE (customers_in_both_years BIGINT) RETURN {body}""")


def customers_in_both_years_function(t: Tables, year1: int = 2017, year2: int = 2016) -> DataFrame:
    """The table function called with (``year1``, ``year2``)."""
    spark = t.orders.sparkSession
    register(spark, t)
    return spark.sql("SELECT * FROM customers_in_both_years(:a, :b)", args={"a": year1, "b": year2})
