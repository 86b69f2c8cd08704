"""Sales reports: revenue by seller, product and category, trends, growth,
moving averages, record and zero-sales periods."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.measures import (
    decimal_ratio, exact_avg, in_years, item_value, month_label, round_half_up_ratio, to_double,
)
from souk.operators import above_mean, asc, desc, moving, running_max, top_k
from souk.operators.ordered import resolve_max_rows
from souk.plans.common import order_totals
from souk.sources import Tables

# Rows of a group with one row per month, or per day, over a thousand years.
MONTH_ROWS, DAY_ROWS = 12_000, 366_000


def _calendar_bound(df: DataFrame, max_rows: int | None, group_rows: int) -> int | None:
    """``group_rows`` where it shows that no group needs a split."""
    return group_rows if group_rows <= resolve_max_rows(df, max_rows) else None


def _sales(df: DataFrame, *keys, name: str = "total_sales") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(item_value()).alias(name))


def seller_revenue_over(t: Tables, min_revenue: float = 50000) -> DataFrame:
    """Sellers whose revenue (price + freight) exceeds ``min_revenue``."""
    rev = _sales(t.order_items, "seller_id", name="total_revenue")
    return (rev.where(F.col("total_revenue") > F.lit(Decimal(str(min_revenue))))
            .select("seller_id", to_double("total_revenue").alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc()))


def monthly_orders(t: Tables) -> DataFrame:
    """Orders per purchase month (``yyyy-MM``), chronological."""
    return (t.orders.groupBy(month_label("order_purchase_timestamp").alias("month"))
            .agg(F.count("order_id").alias("total_orders"))
            .orderBy("month"))


def top_products_rank(t: Tables, k: int = 5) -> DataFrame:
    """Products whose sales rank (ties share a rank) is at most ``k``."""
    ps = _sales(t.order_items, "product_id")
    return (top_k(ps, [desc("total_sales")], k, ties="rank", rank_col="sales_rank")
            .select("product_id", to_double("total_sales").alias("total_sales"), "sales_rank"))


def top_products_dense(t: Tables, k: int = 5) -> DataFrame:
    """Products whose sales are among the ``k`` highest distinct totals."""
    ps = _sales(t.order_items, "product_id")
    return (top_k(ps, [desc("total_sales")], k, ties="dense", rank_col="sales_rank")
            .select("product_id", to_double("total_sales").alias("total_sales"), "sales_rank"))


def _product_sales(t: Tables, *keys: str) -> DataFrame:
    """Item value per (product, *keys), joined to the product's category.

    Items are summed per product before they meet ``products`` (``product_id``
    is its key): the join sees one row per product (and key), not per item,
    and a best-selling product is collapsed map-side before any shuffle."""
    per = _sales(t.order_items, "product_id", *keys, name="_v")
    return per.join(t.products, "product_id")


def _category_sales(t: Tables) -> DataFrame:
    return _product_sales(t).groupBy("product_category_name").agg(F.sum("_v").alias("total_sales"))


def top_categories_limit(t: Tables, k: int = 10) -> DataFrame:
    """Exactly ``k`` categories by sales (ties cut by category name)."""
    return (top_k(_category_sales(t), [desc("total_sales"), asc("product_category_name")], k)
            .select("product_category_name", to_double("total_sales").alias("total_sales")))


def top_categories_rank(t: Tables, k: int = 10) -> DataFrame:
    """Categories whose sales rank is at most ``k`` (ties kept)."""
    return (top_k(_category_sales(t), [desc("total_sales")], k, ties="rank", rank_col="sales_rank")
            .select("product_category_name", to_double("total_sales").alias("total_sales"),
                    "sales_rank"))


def priciest_products(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` products with the highest average unit price."""
    avg = t.order_items.groupBy("product_id").agg(exact_avg("price").alias("avg_price"))
    return top_k(avg, [desc("avg_price"), asc("product_id")], k)


def bottom_products(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` products with the lowest sales (among products that sold)."""
    s = _sales(t.order_items, "product_id", name="sales")
    return (top_k(s, [asc("sales"), asc("product_id")], k)
            .select("product_id", to_double("sales").alias("sales")))


def top_sellers_per_category(t: Tables, k: int = 3) -> DataFrame:
    """The ``k`` best sellers of every category (row number, seller id breaks ties)."""
    cs = (_product_sales(t, "seller_id").groupBy("product_category_name", "seller_id")
          .agg(F.sum("_v").alias("total_sales")))
    return (top_k(cs, [desc("total_sales"), asc("seller_id")], k,
                  partition=["product_category_name"])
            .select("seller_id", "product_category_name",
                    to_double("total_sales").alias("total_sales")))


def top_seller_per_category(t: Tables) -> DataFrame:
    """The best-selling seller of every category (seller id breaks ties)."""
    return top_sellers_per_category(t, 1).select(
        "product_category_name", "seller_id", "total_sales").orderBy(F.col("total_sales").desc())


def top_products_per_category(t: Tables, k: int = 5) -> DataFrame:
    """The ``k`` best-selling products of every category with their row number."""
    ps = _product_sales(t).select("product_category_name", "product_id",
                                  F.col("_v").alias("total_sales"))
    return (top_k(ps, [desc("total_sales"), asc("product_id")], k,
                  partition=["product_category_name"], rank_col="sales_rank")
            .select("product_category_name", "product_id",
                    to_double("total_sales").alias("total_sales"), "sales_rank")
            .orderBy("product_category_name", "sales_rank"))


def products_above_avg_sales(t: Tables) -> DataFrame:
    """Products whose sales exceed the mean sales per product."""
    s = _sales(t.order_items, "product_id", name="sales")
    return above_mean(s, "sales").select("product_id", to_double("sales").alias("sales"))


def product_order_counts(t: Tables) -> DataFrame:
    """Every product with the number of distinct orders it was in (0 if none).

    Items are counted per product first (the distinct count shuffles on
    (product, order), then partial counts on product), and only the one-row-
    per-product result meets ``products`` in the outer join: a best-selling
    product never concentrates its item rows in one join task."""
    counts = (t.order_items.groupBy("product_id")
              .agg(F.countDistinct("order_id").alias("_orders")))
    return (t.products.join(counts, "product_id", "left")
            .select("product_id", "product_category_name",
                    F.coalesce(F.col("_orders"), F.lit(0)).alias("order_count"))
            .orderBy(F.col("order_count").desc(), "product_id"))


def best_year_per_calendar_month(t: Tables) -> DataFrame:
    """For each calendar month 1-12, the sales of its best year (ties kept)."""
    ts = F.col("order_purchase_timestamp")
    ym = order_totals(t).groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")) \
        .agg(F.sum("order_value").alias("sales"))
    return (top_k(ym, [desc("sales")], 1, partition=["month"], ties="rank")
            .select("month", to_double("sales").alias("sales")))


def best_month(t: Tables) -> DataFrame:
    """The single (year, month) with the highest sales."""
    ts = F.col("order_purchase_timestamp")
    ym = order_totals(t).groupBy(F.year(ts).alias("sales_year"), F.month(ts).alias("sales_month")) \
        .agg(F.sum("order_value").alias("total_sales"))
    return (top_k(ym, [desc("total_sales"), asc("sales_year"), asc("sales_month")], 1)
            .select("sales_year", "sales_month", to_double("total_sales").alias("total_sales")))


def aov_per_year(t: Tables) -> DataFrame:
    """Average order value (sales / distinct orders) per purchase year."""
    ts = F.col("order_purchase_timestamp")
    return (order_totals(t).groupBy(F.year(ts).alias("yr"))
            .agg((F.sum("order_value").cast("double") / F.count(F.lit(1))).alias("aov"))
            .orderBy(F.col("aov").desc()))


def category_growth(t: Tables, year1: int = 2017, year2: int = 2018) -> DataFrame:
    """Sales per category in two years and the increase, all categories that
    sold in either year (0 for a year without sales)."""
    ts = F.col("order_purchase_timestamp")
    v, y = item_value(), F.year(ts)
    # the pivot happens per product, before the join with products
    per = (t.order_items.join(t.orders.where(in_years(ts, [year1, year2]))
                              .select("order_id", "order_purchase_timestamp"), "order_id")
           .groupBy("product_id").agg(F.sum(F.when(y == year1, v)).alias("_s1"),
                                      F.sum(F.when(y == year2, v)).alias("_s2")))
    g = per.join(t.products, "product_id").groupBy("product_category_name").agg(
        F.coalesce(F.sum("_s1"), F.lit(0)).alias("s1"), F.coalesce(F.sum("_s2"), F.lit(0)).alias("s2"))
    return (g.select("product_category_name",
                     to_double("s1").alias(f"sales_{year1}"),
                     to_double("s2").alias(f"sales_{year2}"),
                     to_double(F.col("s2") - F.col("s1")).alias("sales_increase"))
            .orderBy(F.col("sales_increase").desc()))


def moving_avg_category(t: Tables, window: int = 3, calendar: bool = False, max_rows: int | None = None,
                        exact: bool = False) -> DataFrame:
    """Daily sales per category with the average over the current and the
    ``window - 1`` previous rows (``calendar=True``: previous calendar days),
    rounded half-up to cents (``exact``: as decimal(18,2)).

    One category holds at most one row per day, so a window partition is
    bounded by the calendar span, not by data volume."""
    # Items are summed per product and day before they meet ``products``.
    per_product = (t.orders.join(t.order_items, "order_id")
                   .groupBy("product_id", F.col("order_purchase_timestamp").cast("date").alias("sale_date"))
                   .agg(F.sum(item_value()).alias("_v")))
    daily = (per_product.join(t.products, "product_id").groupBy("product_category_name", "sale_date")
             .agg(F.sum("_v").alias("daily_sales")))
    if calendar:
        w = (Window.partitionBy("product_category_name").orderBy(F.unix_date("sale_date"))
             .rangeBetween(-(window - 1), 0))
        daily = daily.withColumns({"_sum": F.sum("daily_sales").over(w), "_n": F.count("daily_sales").over(w)})
    else:
        daily = moving(daily, "daily_sales", ["product_category_name"], [asc("sale_date")], window, "_sum", "_n",
                       max_rows=max_rows, rows=_calendar_bound(daily, max_rows, DAY_ROWS))
    avg = decimal_ratio(F.col("_sum"), F.col("_n"), 18) if exact else round_half_up_ratio(F.col("_sum"), F.col("_n"))
    return (daily.select("product_category_name", "sale_date",
                         (F.col("daily_sales").cast("decimal(18,2)") if exact else to_double("daily_sales"))
                         .alias("daily_sales"),
                         avg.alias("moving_avg_3day"))
            .orderBy("product_category_name", "sale_date"))


def record_months(t: Tables, max_rows: int | None = None) -> DataFrame:
    """Months in which a category sold more than in every earlier month
    (its first month counts as a record): an exclusive running maximum."""
    per_product = (t.orders.join(t.order_items, "order_id")
                   .groupBy("product_id", month_label("order_purchase_timestamp").alias("month"))
                   .agg(F.sum(item_value()).alias("_v")))
    m = (per_product.join(t.products, "product_id").groupBy("product_category_name", "month")
         .agg(F.sum("_v").alias("sales")))
    best = running_max(m, "sales", ["product_category_name"], [asc("month")], "_best", exclusive=True,
                       max_rows=max_rows, rows=_calendar_bound(m, max_rows, MONTH_ROWS))
    return (best.where(F.col("_best").isNull() | (F.col("sales") > F.col("_best")))
            .select("product_category_name", "month", to_double("sales").alias("sales")))


def zero_sales_days(t: Tables) -> DataFrame:
    """Days between the first and the last purchase day without any item sold.

    The calendar is generated from a one-row aggregate with ``sequence`` (a
    day spine; its length is the covered span in days, independent of data
    volume) and anti-joined with the days that had sales."""
    day = F.col("order_purchase_timestamp").cast("date")
    span = t.orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    # distinct days (map-side partial aggregation: one row per day per task,
    # so a day holding most orders is no hot key) before the anti join
    sold = order_totals(t).select(day.alias("day")).distinct()
    return calendar.join(sold, "day", "left_anti").orderBy("day")
