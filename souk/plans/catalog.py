"""Registry of every report with the arguments used on the supplied test data.

Report functions keep the reference questions' literals as defaults (years
2017/2018, 50,000 revenue, ...).  On the supplied tables the order years run
1995-2001, so years 2016/2017/2018 map to 1996/1997/1998; the category
literal maps to an existing brand/type category that some sellers never
sold; and the revenue threshold is set inside the observed per-seller range
so the filter selects a part of the sellers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from souk.plans import customers, logistics, procedures, sales, sellers
from souk.session import configure
from souk.sources import Tables, standin_tables

# Fixed values for the stand-in data.
YEAR_A, YEAR_B, YEAR_BEFORE = 1997, 1998, 1996
CATEGORY = "Brand#7_PROMO"
MIN_SELLER_REVENUE = 31_000_000

REGISTRY: dict[str, tuple[Callable[..., DataFrame], dict]] = {
    "seller_revenue_over": (sales.seller_revenue_over, {"min_revenue": MIN_SELLER_REVENUE}),
    "monthly_orders": (sales.monthly_orders, {}),
    "top_products_rank": (sales.top_products_rank, {}),
    "repeat_customers": (customers.repeat_customers, {}),
    "product_review_avg": (logistics.product_review_avg, {}),
    "order_rank_per_customer": (customers.order_rank_per_customer, {}),
    "delivery_days_by_state": (logistics.delivery_days_by_state, {}),
    "late_pct": (logistics.late_pct, {}),
    "top_seller_per_category": (sales.top_seller_per_category, {}),
    "customer_ltv": (customers.customer_ltv, {}),
    "top_categories_limit": (sales.top_categories_limit, {}),
    "top_categories_rank": (sales.top_categories_rank, {}),
    "priciest_products": (sales.priciest_products, {}),
    "bottom_products": (sales.bottom_products, {}),
    "top_customers": (customers.top_customers, {}),
    "top_customers_per_state": (customers.top_customers_per_state, {}),
    "customer_segments": (customers.customer_segments, {}),
    "top_sellers_per_category": (sales.top_sellers_per_category, {}),
    "worst_delay_seller": (sellers.worst_delay_seller, {}),
    "slowest_states": (logistics.slowest_states, {}),
    "most_late_customers": (customers.most_late_customers, {}),
    "order_rank_joined": (customers.order_rank_joined, {}),
    "moving_avg_category": (sales.moving_avg_category, {}),
    "seller_first_last_order": (sellers.seller_first_last_order, {}),
    "customer_running_sales": (customers.customer_running_sales, {}),
    "purchase_gaps": (customers.purchase_gaps, {}),
    "customers_with_orders_left": (customers.customers_with_orders_left, {}),
    "sellers_unmatched_left_join": (sellers.sellers_unmatched_left_join, {"category": CATEGORY}),
    "sellers_never_in_category": (sellers.sellers_never_in_category, {"category": CATEGORY}),
    "order_city_pairs": (logistics.order_city_pairs, {}),
    "product_order_counts": (sales.product_order_counts, {}),
    "order_freight": (logistics.order_freight, {}),
    "best_year_per_calendar_month": (sales.best_year_per_calendar_month, {}),
    "best_month": (sales.best_month, {}),
    "best_rated_products": (logistics.best_rated_products, {}),
    "sellers_above_avg_revenue": (sellers.sellers_above_avg_revenue, {}),
    "customers_above_p90": (customers.customers_above_p90, {}),
    "seller_speed_rank": (sellers.seller_speed_rank, {}),
    "max_payment_orders": (logistics.max_payment_orders, {}),
    "products_above_avg_sales": (sales.products_above_avg_sales, {}),
    "sellers_above_median_orders": (sellers.sellers_above_median_orders, {}),
    "beat_year_max_spend": (customers.beat_year_max_spend, {"year": YEAR_A}),
    "aov_per_year": (sales.aov_per_year, {}),
    "state_sales_profile": (customers.state_sales_profile, {}),
    "customers_in_both_years": (customers.customers_in_both_years, {"year1": YEAR_A, "year2": YEAR_B}),
    "customers_in_both_years_call": (procedures.customers_in_both_years_sql,
                                     {"year1": YEAR_A, "year2": YEAR_BEFORE}),
    "lowest_rated_months": (logistics.lowest_rated_months, {}),
    "late_pct_per_year": (logistics.late_pct_per_year, {}),
    "top_aov_per_state": (customers.top_aov_per_state, {}),
    "category_growth": (sales.category_growth, {"year1": YEAR_A, "year2": YEAR_B}),
    "best_month_per_customer": (customers.best_month_per_customer, {}),
    "category_p90_delivery": (logistics.category_p90_delivery, {}),
    "seller_review_rank": (sellers.seller_review_rank, {}),
    "top_products_per_category": (sales.top_products_per_category, {}),
    "avg_purchase_gap": (customers.avg_purchase_gap, {}),
    "seller_monthly_drop": (sellers.seller_monthly_drop, {}),
    "customers_in_both_years_function": (procedures.customers_in_both_years_function,
                                         {"year1": YEAR_A, "year2": YEAR_BEFORE}),
    "late_pct_decimal": (logistics.late_pct, {"exact": True}),
    "customer_ltv_decimal": (customers.customer_ltv, {"exact": True}),
    "moving_avg_category_decimal": (sales.moving_avg_category, {"exact": True}),
    "delivery_days_by_state_exact": (logistics.delivery_days_by_state, {"integer_avg": False}),
    "lowest_rated_months_truncated": (logistics.lowest_rated_months, {"integer_avg": True}),
    "zero_sales_days": (sales.zero_sales_days, {}),
    "record_months": (sales.record_months, {}),
    "order_prev_next": (customers.order_prev_next, {}),
    "top_products_dense": (sales.top_products_dense, {}),
    "moving_avg_category_calendar": (sales.moving_avg_category, {"calendar": True}),
}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The stand-in bundle for ``sf_dir``, from the files that are there now."""
    return standin_tables(configure(spark), sf_dir)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the registered report ``name`` on the supplied tables in ``sf_dir``."""
    fn, kwargs = REGISTRY[name]
    return fn(tables(spark, sf_dir), **kwargs)


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A ``(spark, sf_dir) -> DataFrame`` callable for the report ``name``."""
    def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(name, spark, sf_dir)
    _run.__name__ = name
    return _run
