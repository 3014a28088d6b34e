"""Cleaned tables -> the four business aggregates.

Facts are always combined per key in the map tasks before they are shuffled,
and joined to dimensions only after that: a product or customer that owns a
third of all rows reaches a reducer as one partial row per map task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.contracts import GOLDEN
from marketloom.functions import clean, exact, scoring
from marketloom.functions.derive import NEGATIVE, NEUTRAL, POSITIVE
from marketloom.operators.ranking import rank_by_level

# A product needs attention below this rating, from this many reviews on.
POOR_RATING = 2.5
ENOUGH_REVIEWS = 5

PRODUCT_LABELS = ("product_name", "category", "brand")


# --- sales ---------------------------------------------------------------

def sales_summary(orders: DataFrame) -> DataFrame:
    """One row per order date (NULL when unparsable) and shipping country."""
    grouped = orders.groupBy(F.col("order_date").alias("order_date_dt"), "shipping_country").agg(
        F.count("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        *exact.money_parts("total_amount"),
        F.min("total_amount").alias("_low"),
        F.max("total_amount").alias("_high"),
    )
    return grouped.select(
        "order_date_dt",
        "shipping_country",
        "total_orders",
        "unique_customers",
        exact.money_total().alias("gross_revenue"),
        exact.money_average().alias("avg_order_value"),
        F.round("_low", 2).alias("min_order_value"),
        F.round("_high", 2).alias("max_order_value"),
    )


# --- products ------------------------------------------------------------

def _review_measures() -> list:
    """Additive review measures; stars are whole numbers, so their sum is exact."""
    bucket = F.col("sentiment_bucket")
    return [
        F.count("review_id").alias("reviews"),
        F.sum("rating").alias("stars"),
        F.count("rating").alias("rated"),
        F.count_if(bucket == POSITIVE).alias("positive"),
        F.count_if(bucket == NEUTRAL).alias("neutral"),
        F.count_if(bucket == NEGATIVE).alias("negative"),
    ]


def product_review_agg(reviews: DataFrame) -> DataFrame:
    """Review count, average rating and sentiment counts per product."""
    return reviews.groupBy("product_id").agg(*_review_measures()).select(
        "product_id",
        F.col("reviews").alias("review_count"),
        exact.ratio("stars", "rated", 2).alias("avg_rating"),
        F.col("positive").alias("positive_reviews"),
        F.col("neutral").alias("neutral_reviews"),
        F.col("negative").alias("negative_reviews"),
    )


def product_scorecard(products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Products with their review figures; products without reviews count 0, rated NULL."""
    counters = ["review_count", "positive_reviews", "neutral_reviews", "negative_reviews"]
    return products.join(product_review_agg(reviews), "product_id", "left").fillna(0, counters)


def rated_rank(scorecard: DataFrame) -> DataFrame:
    """Global rank by average rating; unrated products come last.

    Ratings of one to five stars in two digits have at most 402 levels.
    """
    return rank_by_level(scorecard, "avg_rating", "rating_rank", few_levels=True)


def with_attention(scorecard: DataFrame) -> DataFrame:
    """The scorecard with the attention flag; what reports read that do not need the rank."""
    attention = (
        F.col("in_stock")
        & (F.col("avg_rating") < POOR_RATING)
        & (F.col("review_count") >= ENOUGH_REVIEWS)
    )
    return scorecard.withColumn("needs_review_flag", attention)


def product_performance(
    products: DataFrame,
    reviews: DataFrame,
    cut: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Scorecard, rank and attention flag per product.

    The scorecard is read twice, for the ranking levels and for the rows;
    ``cut`` may store it (see ``sources.scratch.stored``) so that the reviews
    are aggregated once.
    """
    ranked = rated_rank(cut(product_scorecard(products, reviews)))
    return with_attention(ranked).select(*GOLDEN["agg_product_performance"].names)


# --- customers -----------------------------------------------------------

def customer_order_agg(orders: DataFrame) -> DataFrame:
    """Order count, spend and first/last order date per customer."""
    return (
        orders.groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            *exact.money_parts("total_amount"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
        )
        .select(
            "customer_id",
            "total_orders",
            exact.money_total().alias("lifetime_value"),
            exact.money_average().alias("avg_order_value"),
            "last_order_date",
            "first_order_date",
        )
    )


def _favourite_method():
    """Method with most orders; on a tie the first by name, a missing one last."""
    method = F.col("payment_method")
    return F.min_by(method, F.struct(-F.col("orders"), method.isNull(), method))


def preferred_payment(orders: DataFrame) -> DataFrame:
    """Most used payment method per customer; a missing method can win."""
    return (
        orders.groupBy("customer_id", "payment_method")
        .agg(F.count("order_id").alias("orders"))
        .groupBy("customer_id")
        .agg(_favourite_method().alias("preferred_payment"))
    )


def customer_order_profile(orders: DataFrame) -> DataFrame:
    """``customer_order_agg`` and ``preferred_payment`` from one scan of the orders.

    Everything is first combined per customer and payment method, which the
    favourite needs anyway; the rest rolls up from there.
    """
    return (
        orders.groupBy("customer_id", "payment_method")
        .agg(
            F.count("order_id").alias("orders"),
            *exact.money_parts("total_amount"),
            F.max("order_date").alias("last"),
            F.min("order_date").alias("first"),
        )
        .groupBy("customer_id")
        .agg(
            F.sum("orders").alias("total_orders"),
            *exact.money_rollup(),
            F.max("last").alias("last_order_date"),
            F.min("first").alias("first_order_date"),
            _favourite_method().alias("preferred_payment"),
        )
        .select(
            "customer_id",
            "total_orders",
            exact.money_total().alias("lifetime_value"),
            exact.money_average().alias("avg_order_value"),
            "last_order_date",
            "first_order_date",
            "preferred_payment",
        )
    )


def customer_review_agg(reviews: DataFrame) -> DataFrame:
    """Reviews written and average rating given per customer."""
    return (
        reviews.groupBy("customer_id")
        .agg(
            F.count("review_id").alias("reviews_written"),
            F.sum("rating").alias("stars"),
            F.count("rating").alias("rated"),
        )
        .select(
            "customer_id",
            "reviews_written",
            exact.ratio("stars", "rated", 2).alias("avg_review_given"),
        )
    )


def with_rfm(profile: DataFrame, as_of: dt.date) -> DataFrame:
    """Add recency/tenure days, the three scores, their sum and the segment.

    A customer without orders has NULL figures and so gets the lowest score
    in each dimension.
    """
    days = scoring.days_until(as_of, "last_order_date")
    recency = scoring.recency_score(days)
    frequency = scoring.frequency_score(F.col("total_orders"))
    monetary = scoring.monetary_score(F.col("lifetime_value"))
    return profile.withColumns(
        {
            "days_since_last_order": days,
            "tenure_days": scoring.days_until(as_of, "signup_date"),
            "recency_score": recency,
            "frequency_score": frequency,
            "monetary_score": monetary,
        }
    ).withColumn(
        "rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    ).withColumn("customer_segment", scoring.segment(F.col("rfm_score")))


def customer_360(
    customers: DataFrame, orders: DataFrame, reviews: DataFrame, as_of: dt.date
) -> DataFrame:
    """One row per customer; the figures of customers who never ordered stay NULL.

    All inputs arrive hashed on customer_id with one row per customer, so the
    joins need no further shuffle and have no hot key.
    """
    joined = customers.join(customer_order_profile(orders), "customer_id", "left").join(
        customer_review_agg(reviews), "customer_id", "left"
    )
    return with_rfm(joined, as_of).select(*GOLDEN["agg_customer_360"].names)


# --- review sentiment ----------------------------------------------------

def reviews_enriched(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Reviews with the name, category and brand of their product; unknown products stay."""
    labels = products.select("product_id", *PRODUCT_LABELS)
    return reviews.join(labels, "product_id", "left")


def by_product_month(reviews: DataFrame, *measures: Column) -> DataFrame:
    """Aggregate per product and month; the month label is made after the grouping."""
    month = F.trunc("review_date", "month")
    return (
        reviews.groupBy("product_id", month.alias("review_month"))
        .agg(*measures)
        .withColumn("review_month", clean.month_bucket("review_month"))
    )


def monthly_sentiment(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Review count, average rating and sentiment counts per month and product.

    The product key is unique in the dimension, so its labels can be joined to
    the monthly rows instead of to every single review.
    """
    monthly = reviews_enriched(by_product_month(reviews, *_review_measures()), products)
    return monthly.select(
        "review_month",
        "product_id",
        *PRODUCT_LABELS,
        F.col("reviews").alias("total_reviews"),
        exact.ratio("stars", "rated", 2).alias("avg_rating"),
        F.col("positive").alias("positive_count"),
        F.col("neutral").alias("neutral_count"),
        F.col("negative").alias("negative_count"),
    )


def with_sentiment_pct(monthly: DataFrame) -> DataFrame:
    return monthly.withColumns(
        {
            "positive_pct": exact.percent("positive_count", "total_reviews"),
            "negative_pct": exact.percent("negative_count", "total_reviews"),
        }
    )


def with_previous(
    df: DataFrame, by: str, order: str, value: str, previous: str, change: str
) -> DataFrame:
    """Value of the preceding existing row of the group, and the difference to it.

    ``df`` must be aggregated to one row per ``by`` and ``order``, so a group
    holds at most one row per calendar period.
    """
    timeline = Window.partitionBy(by).orderBy(F.col(order).asc_nulls_first())
    return df.withColumn(previous, F.lag(value).over(timeline)).withColumn(
        change, F.round(F.col(value) - F.col(previous), 2)
    )


def review_sentiment(reviews: DataFrame, products: DataFrame) -> DataFrame:
    monthly = with_sentiment_pct(monthly_sentiment(reviews, products))
    return with_previous(
        monthly,
        "product_id",
        "review_month",
        "avg_rating",
        "prev_month_avg_rating",
        "rating_mom_change",
    )
