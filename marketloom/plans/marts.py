"""Dashboard data sets and the described analytics, on silver and golden tables.

Averages and distinct counts are never averaged or added again: where a report
needs them at a coarser grain it goes back to additive sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import exact
from marketloom.functions.base import ladder
from marketloom.plans import golden

# Thresholds and labels of the dashboard's sales flag.
HIGH_SALES = 60000
LOW_RATING = 3.3
SALES_FLAGS = ("High Sales, Low Rating", "High Sales", "Low Rating", "Normal")
SENTIMENTS = ("Positive", "Neutral", "Negative")  # display order
REENGAGE = ("At Risk", "Hibernating")
TOP = 10


def week_start(day: Column | str) -> Column:
    """Monday of the week of a date."""
    return F.trunc(day, "week")


def _measure(grouped, amount: str, *more: Column) -> DataFrame:
    return grouped.agg(*more, *exact.money_parts(amount))


# --- sales ---------------------------------------------------------------

def revenue_by_country(sales: DataFrame) -> DataFrame:
    return _measure(
        sales.groupBy("shipping_country"), "gross_revenue", F.sum("total_orders").alias("orders")
    ).select(
        "shipping_country", exact.money_total().alias("total_revenue"), "orders"
    )


def top_countries(sales: DataFrame, n: int = TOP) -> DataFrame:
    return (
        revenue_by_country(sales)
        .select("shipping_country", "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("shipping_country").asc_nulls_last())
        .limit(n)
    )


def order_value_series(sales: DataFrame) -> DataFrame:
    """Sum over countries of the daily average order value, by date (as the dashboard has it)."""
    return (
        _measure(sales.groupBy("order_date_dt"), "avg_order_value")
        .select("order_date_dt", exact.money_total().alias("total_order_value"))
        .orderBy(F.col("order_date_dt").asc_nulls_first())
    )


def aov_series(sales: DataFrame) -> DataFrame:
    """Revenue per order by date: what a chart titled 'average order value' should show.

    Orders without a valid amount count as orders, so this is not the mean of
    the valid amounts.
    """
    daily = _measure(
        sales.groupBy("order_date_dt"), "gross_revenue", F.sum("total_orders").alias("orders")
    ).select("order_date_dt", "orders", exact.money_total().alias("revenue"))
    cents = F.rint(F.col("revenue") * 100)
    return daily.select(
        "order_date_dt",
        "revenue",
        "orders",
        (F.round(cents / F.nullif("orders", F.lit(0))) / 100).alias("avg_order_value"),
    ).orderBy(F.col("order_date_dt").asc_nulls_first())


def weekly_revenue_wow(sales: DataFrame) -> DataFrame:
    """Revenue per Monday-to-Sunday week against the preceding week with orders.

    The window has no partition, but it runs over one row per calendar week.
    """
    weekly = _measure(
        sales.where(F.col("order_date_dt").isNotNull()).groupBy(
            week_start("order_date_dt").alias("week_start")
        ),
        "gross_revenue",
    ).select("week_start", exact.money_total().alias("gross_revenue"))
    before = F.lag("gross_revenue").over(Window.orderBy("week_start"))
    now_c, then_c = F.rint(F.col("gross_revenue") * 100), F.rint(F.col("prev_revenue") * 100)
    return weekly.withColumn("prev_revenue", before).select(
        "week_start",
        "gross_revenue",
        "prev_revenue",
        ((now_c - then_c) / 100).alias("revenue_change"),
        exact.percent(now_c - then_c, then_c).alias("change_pct"),
    )


def two_weeks(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day that ``kpi_week_vs_prev`` looks at; give them to the store's ``read``."""
    monday = as_of - dt.timedelta(days=as_of.weekday())
    return monday - dt.timedelta(days=7), monday + dt.timedelta(days=6)


def kpi_week_vs_prev(orders: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders, revenue, average order value and distinct customers: this week, last week.

    One row. "This week" is the Monday-to-Sunday week of ``as_of``.  Customers
    are counted from the orders; each is first reduced to one row per week, so
    no distinct set is held anywhere.
    """
    monday = as_of - dt.timedelta(days=as_of.weekday())
    first, last = two_weeks(as_of)
    per_customer = _measure(
        orders.where(F.col("order_date").between(F.lit(first), F.lit(last))).groupBy(
            (F.col("order_date") >= F.lit(monday)).alias("current"), "customer_id"
        ),
        "total_amount",
        F.count("order_id").alias("orders"),
    )
    weeks = {"current": F.col("current"), "previous": ~F.col("current")}
    sums = []
    for name, chosen in weeks.items():
        sums += [
            F.coalesce(F.sum(F.when(chosen, F.col("orders"))), F.lit(0)).alias(f"{name}_orders"),
            F.count_if(chosen).alias(f"{name}_customers"),
            *[
                F.sum(F.when(chosen, F.col(part))).alias(f"{name}_{part}")
                for part in exact.PARTS
            ],
        ]
    out = [F.lit(monday).alias("week_start")]
    for name in weeks:
        out += [
            F.col(f"{name}_orders"),
            exact.money_total(f"{name}_").alias(f"{name}_revenue"),
            exact.money_average(f"{name}_").alias(f"{name}_aov"),
            F.col(f"{name}_customers"),
        ]
    return per_customer.agg(*sums).select(*out)


def orders_by_weekday(sales: DataFrame) -> DataFrame:
    """Order volume per day of week, 0 = Monday; undated orders are left out."""
    return (
        sales.where(F.col("order_date_dt").isNotNull())
        .groupBy(F.weekday("order_date_dt").alias("weekday"))
        .agg(F.sum("total_orders").alias("total_orders"))
    )


# --- products and sentiment ----------------------------------------------

def estimated_sales(performance: DataFrame) -> DataFrame:
    """Price times review count, a stand-in for sales volume."""
    return performance.withColumn("estimated_sales", F.col("price") * F.col("review_count"))


def sales_flag(
    performance: DataFrame, high_sales: float = HIGH_SALES, low_rating: float = LOW_RATING
) -> DataFrame:
    """Products marked by estimated sales and rating; unknown values count as normal."""
    both, selling, poor, normal = SALES_FLAGS
    high, low = F.col("estimated_sales") > high_sales, F.col("avg_rating") < low_rating
    return estimated_sales(performance).select(
        "product_id",
        "product_name",
        "category",
        "review_count",
        "avg_rating",
        "estimated_sales",
        ladder([(high & low, both), (high, selling), (low, poor)], normal).alias(
            "sales_performance_flag"
        ),
    )


def _sentiment_sums() -> list[Column]:
    return [F.sum(f"{s.lower()}_count").alias(s) for s in SENTIMENTS]


def sentiment_by_category(sentiment: DataFrame) -> DataFrame:
    """One row per category and sentiment, from one aggregation."""
    return (
        sentiment.groupBy("category")
        .agg(*_sentiment_sums())
        .unpivot("category", list(SENTIMENTS), "sentiment_type", "review_count")
    )


def sentiment_total(sentiment: DataFrame) -> DataFrame:
    """Reviews per sentiment in display order."""
    place = ladder(
        [(F.col("sentiment_type") == s, i) for i, s in enumerate(SENTIMENTS)], len(SENTIMENTS)
    )
    return (
        sentiment.agg(*_sentiment_sums())
        .unpivot([], list(SENTIMENTS), "sentiment_type", "review_count")
        .orderBy(place)
    )


def sentiment_split(sentiment: DataFrame) -> DataFrame:
    """Shares of the three sentiments per category and overall.

    Categories are summed first, so the overall row adds up few rows.
    """
    names = [s.lower() for s in SENTIMENTS]
    by_category = sentiment.groupBy("category").agg(*[F.sum(f"{s}_count").alias(s) for s in names])
    split = by_category.rollup("category").agg(
        F.grouping("category").alias("overall"), *[F.sum(s).alias(s) for s in names]
    )
    total = reduce(lambda a, b: a + b, [F.col(s) for s in names])
    return split.select(
        (F.col("overall") == 1).alias("is_overall"),
        "category",
        *names,
        *[exact.percent(s, total).alias(f"{s}_pct") for s in names],
    )


def price_vs_rating(performance: DataFrame) -> DataFrame:
    """Scatter points: priced products that have a rating."""
    return performance.where(
        F.col("price").isNotNull() & F.col("avg_rating").isNotNull()
    ).select("product_id", "category", "price_category", "price", "avg_rating", "review_count")


def top_bottom_products(performance: DataFrame, n: int = TOP) -> DataFrame:
    """The n best and n worst rated products."""
    rated = performance.where(F.col("avg_rating").isNotNull()).select(
        "product_id", "product_name", "avg_rating", "review_count"
    )

    def end(name: str, order: Column) -> DataFrame:
        return rated.orderBy(order, "product_id").limit(n).withColumn("list_name", F.lit(name))

    rating = F.col("avg_rating")
    return end("top", rating.desc()).unionByName(end("bottom", rating.asc()))


def _star_sums() -> list[Column]:
    return [
        F.count("review_id").alias("reviews"),
        F.sum("rating").alias("stars"),
        F.count("rating").alias("rated"),
    ]


def _rating_by(per_product: DataFrame, products: DataFrame, *labels: str) -> DataFrame:
    """Exact average rating per label, from star sums per product."""
    return (
        golden.reviews_enriched(per_product, products)
        .groupBy(*labels)
        .agg(*[F.sum(c).alias(c) for c in ("reviews", "stars", "rated")])
        .select(
            *labels,
            F.col("reviews").alias("review_count"),
            exact.ratio("stars", "rated", 2).alias("avg_rating"),
        )
    )


def category_brand_heatmap(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Average rating per category and brand over all their reviews."""
    per_product = reviews.groupBy("product_id").agg(*_star_sums())
    return _rating_by(per_product, products, "category", "brand")


def category_rating_trend(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Average rating per category and month, with the change to the month before."""
    per_product = golden.by_product_month(reviews, *_star_sums())
    monthly = _rating_by(per_product, products, "category", "review_month")
    return golden.with_previous(
        monthly, "category", "review_month", "avg_rating", "prev_avg_rating", "rating_change"
    )


def needs_review_list(performance: DataFrame) -> DataFrame:
    return performance.where("needs_review_flag").select(
        "product_id", "product_name", "category", "brand", "avg_rating", "review_count"
    )


def unreviewed_products(performance: DataFrame) -> DataFrame:
    """Products without an average rating: never reviewed, or never with valid stars."""
    return performance.where(F.col("avg_rating").isNull()).select(
        "product_id", "product_name", "category", "brand", "review_count"
    )


def stock_by_category(performance: DataFrame) -> DataFrame:
    return performance.groupBy("category").agg(
        F.count_if("in_stock").alias("in_stock_products"),
        F.count_if(~F.col("in_stock")).alias("out_of_stock_products"),
    )


# --- customers -----------------------------------------------------------

def segment_counts(customers: DataFrame) -> DataFrame:
    """Customers per segment, over the whole table."""
    return customers.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


def customer_kpis(customers: DataFrame) -> DataFrame:
    champions = F.count_if(F.col("customer_segment") == "Champions")
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        *exact.money_parts("lifetime_value"),
        F.sum("tenure_days").alias("days"),
        F.count("tenure_days").alias("tenured"),
        champions.alias("champions"),
    ).select(
        "total_customers",
        exact.money_average().alias("avg_lifetime_value"),
        exact.ratio("days", "tenured", 1).alias("avg_tenure_days"),
        exact.percent("champions", "total_customers").alias("champions_pct"),
    )


def ltv_by_segment(customers: DataFrame) -> DataFrame:
    """Average lifetime value per segment, over customers that have one."""
    return _measure(customers.groupBy("customer_segment"), "lifetime_value").select(
        "customer_segment",
        F.col("paid").alias("paying_customers"),
        exact.money_average().alias("avg_lifetime_value"),
    )


def champions_by_country(customers: DataFrame, n: int = TOP) -> DataFrame:
    return (
        customers.where(F.col("customer_segment") == "Champions")
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("champions"))
        .orderBy(F.col("champions").desc(), F.col("country").asc_nulls_last())
        .limit(n)
    )


def payment_by_segment(customers: DataFrame) -> DataFrame:
    """Preferred payment per segment with its share of the segment.

    The window runs over one row per segment and method.
    """
    counts = customers.groupBy("customer_segment", "preferred_payment").agg(
        F.count(F.lit(1)).alias("customers")
    )
    segment_size = F.sum("customers").over(Window.partitionBy("customer_segment"))
    return counts.withColumn("share_pct", exact.percent(F.col("customers"), segment_size))


def recency_monetary_grid(customers: DataFrame) -> DataFrame:
    return customers.groupBy("recency_score", "monetary_score", "customer_segment").agg(
        F.count(F.lit(1)).alias("customers")
    )


def reengagement_list(customers: DataFrame) -> DataFrame:
    """Lapsing customers, most valuable first."""
    return (
        customers.where(F.col("customer_segment").isin(*REENGAGE))
        .select(
            "customer_id", "name", "email", "customer_segment", "lifetime_value", "last_order_date"
        )
        .orderBy(F.col("lifetime_value").desc_nulls_last(), "customer_id")
    )


def activation_rate(customers: DataFrame) -> DataFrame:
    """Share of customers with at least one order."""
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("total_orders") >= 1).alias("active_customers"),
    ).withColumn("activation_pct", exact.percent("active_customers", "total_customers"))


# --- operations ----------------------------------------------------------

def weekly_orders_vs_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders and reviews per week; both are counted in one aggregation over their union."""

    def dated(df: DataFrame, day: str, is_order: bool) -> DataFrame:
        return df.where(F.col(day).isNotNull()).select(
            week_start(day).alias("week_start"), F.lit(is_order).alias("is_order")
        )

    return (
        dated(orders, "order_date", True)
        .unionAll(dated(reviews, "review_date", False))
        .groupBy("week_start")
        .agg(
            F.count_if("is_order").alias("order_count"),
            F.count_if(~F.col("is_order")).alias("review_count"),
        )
    )


def valid_payment_rate(orders: DataFrame) -> DataFrame:
    """Share of orders with a known payment method per week; a missing method is not known."""
    return (
        orders.where(F.col("order_date").isNotNull())
        .groupBy(week_start("order_date").alias("week_start"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if("is_valid_payment").alias("valid_orders"),
        )
        .withColumn("valid_rate", exact.ratio("valid_orders", "orders", 4))
    )


def freshness(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Latest processing time per table."""
    return reduce(
        DataFrame.unionAll,
        [
            df.agg(F.max("silver_ts").alias("last_run")).select(
                F.lit(name).alias("table_name"), "last_run"
            )
            for name, df in silver.items()
        ],
    )


# --- previews ------------------------------------------------------------

def preview(df: DataFrame, keys: list[str], n: int = TOP) -> DataFrame:
    """First n rows in key order, so that repeated calls agree."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(n)
