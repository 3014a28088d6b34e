"""Do the tables agree with each other?

Each comparison first combines both sides to one row per key, in the map tasks before the shuffle, and
joins those: a customer or product with a third of all facts is one partial row per map task, and no
side is broadcast unless Spark finds it small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.contracts import AUDIT_COLUMNS
from marketloom.functions import clean, exact
from marketloom.sources.scratch import stored

# Keys of facts and the dimension that must know them.
REFERENCES = (
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_reviews", "customer_id", "dim_customers"),
    ("fact_reviews", "product_id", "dim_products"),
)

# What is compared of the golden tables, and columns of the silver tables that none of it is made of.
COMPARED = {
    "agg_sales_summary": ("order_date_dt", "shipping_country", "total_orders", "gross_revenue"),
    "agg_product_performance": ("product_id", "review_count"),
    "agg_customer_360": ("customer_id", "total_orders", "reviews_written"),
    "agg_review_sentiment": ("review_month", "product_id", "total_reviews"),
}
UNREAD = ("review_text", "review_length", "order_date_key", "is_valid_payment", *AUDIT_COLUMNS)


def rows_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, figure): the rows of each key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("figure"))


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """(key, rows): keys of the fact that the dimension does not know, with the rows that hang on them.

    A NULL key is an orphan: no dimension row can match it.
    """
    return rows_per_key(fact, key).join(dimension.select(key), key, "left_anti").withColumnRenamed("figure", "rows")


def known(counted: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """(key, figure) of the fact's keys that the dimension knows, of ``rows_per_key`` of the fact."""
    return counted.join(dimension.select(key), key, "left_semi")


def orphan_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every orphaned key of every reference, with its rows: the list behind the report."""
    return reduce(
        DataFrame.unionAll,
        [
            orphans(tables[fact], tables[dimension], key).select(
                F.lit(fact).alias("table_name"), F.lit(dimension).alias("reference_table"), F.lit(key).alias("key_name"),
                F.col(key).alias("key_value"), F.col("rows").alias("orphan_rows"),
            )
            for fact, key, dimension in REFERENCES
        ],
    )


def _compared(
    name: str, left_table: str, right_table: str, keys: Sequence[str], left: DataFrame, right: DataFrame,
    subset: bool = False,
) -> DataFrame:
    """One row about two frames of (keys, figure): keys on one side only, keys whose figures differ, totals.

    With ``subset`` the left keys need only exist on the right, whose figures do not count.  NULL is a
    key like any other.
    """
    # the last key has the most values, and sorts compare the first one by its leading bytes
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in reversed(keys)])
    here, there = F.col("l.here"), F.col("r.here")
    figures = F.col("l.figure"), F.col("r.figure")
    joined = left.withColumn("here", F.lit(True)).alias("l").join(
        right.withColumn("here", F.lit(True)).alias("r"), same, "full_outer"
    )
    both = here.isNotNull() & there.isNotNull()
    right_total = F.sum(F.when(both, figures[0])) if subset else F.sum(figures[1])
    row = joined.agg(
        F.count(here).alias("left_keys"),
        F.count(there).alias("right_keys"),
        F.count_if(here.isNotNull() & there.isNull()).alias("only_left"),
        F.count_if(here.isNull() & there.isNotNull()).alias("only_right"),
        (F.lit(0).cast("long") if subset else F.count_if(both & ~figures[0].eqNullSafe(figures[1]))).alias("differing"),
        F.coalesce(F.sum(figures[0]), F.lit(0)).cast("long").alias("left_total"),
        F.coalesce(right_total, F.lit(0)).cast("long").alias("right_total"),
    )
    wrong = F.col("only_left") if subset else F.col("only_left") + F.col("only_right") + F.col("differing")
    return row.select(
        F.lit(name).alias("check_name"), F.lit(left_table).alias("left_table"), F.lit(right_table).alias("right_table"),
        F.lit(", ".join(keys)).alias("key_name"), *row.columns, (wrong == 0).alias("consistent"),
    )


def consistency_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per comparison: facts against dimensions, golden tables against the silver ones.

    ``tables`` holds the four silver and four golden tables.  A golden figure is compared with the facts
    key by key, so errors that cancel in the total are found as well.  Revenue is in cents.  The rows per
    key of the facts are counted and stored once; two comparisons each read them.
    """
    customers, products = tables["dim_customers"], tables["dim_products"]
    orders, reviews = tables["fact_orders"], tables["fact_reviews"]
    sales, scorecard = tables["agg_sales_summary"], tables["agg_product_performance"]
    profiles, sentiment = tables["agg_customer_360"], tables["agg_review_sentiment"]

    def published(df: DataFrame, figure: str, *keys: str) -> DataFrame:
        return df.where(F.coalesce(F.col(figure), F.lit(0)) > 0).select(*keys, F.col(figure).alias("figure"))

    def present(df: DataFrame, key: str) -> DataFrame:
        return rows_per_key(df, key)

    def cents(amount: Column) -> Column:
        return F.rint(amount * 100).cast("long").alias("figure")

    day = ("order_date_dt", "shipping_country")
    dated = orders.withColumnRenamed("order_date", day[0])
    month = ("review_month", "product_id")
    per_day = reviews.groupBy("product_id", F.trunc("review_date", "month").alias("review_month")).agg(
        F.count(F.lit(1)).alias("figure")
    )
    monthly = per_day.select(clean.month_bucket("review_month").alias("review_month"), "product_id", "figure")

    counted = {(fact, key): stored(rows_per_key(tables[fact], key), "counted") for fact, key, _ in REFERENCES}
    checks = [
        _compared("orphans", fact, dimension, [key], counted[fact, key], present(tables[dimension], key), True)
        for fact, key, dimension in REFERENCES
    ]
    checks += [
        _compared("orders", "agg_sales_summary", "fact_orders", day,
                  published(sales, "total_orders", *day), rows_per_key(dated, *day)),
        _compared("revenue_cents", "agg_sales_summary", "fact_orders", day,
                  sales.select(*day, cents(F.col("gross_revenue"))),
                  dated.groupBy(*day).agg(*exact.money_parts("total_amount")).select(*day, cents(exact.money_total()))),
        _compared("orders", "agg_customer_360", "fact_orders", ["customer_id"],
                  published(profiles, "total_orders", "customer_id"), known(counted["fact_orders", "customer_id"], customers, "customer_id")),
        _compared("reviews", "agg_customer_360", "fact_reviews", ["customer_id"],
                  published(profiles, "reviews_written", "customer_id"), known(counted["fact_reviews", "customer_id"], customers, "customer_id")),
        _compared("reviews", "agg_product_performance", "fact_reviews", ["product_id"],
                  published(scorecard, "review_count", "product_id"), known(counted["fact_reviews", "product_id"], products, "product_id")),
        _compared("reviews", "agg_review_sentiment", "fact_reviews", month,
                  published(sentiment, "total_reviews", *month), monthly),
        _compared("rows", "agg_customer_360", "dim_customers", ["customer_id"],
                  present(profiles, "customer_id"), present(customers, "customer_id")),
        _compared("rows", "agg_product_performance", "dim_products", ["product_id"],
                  present(scorecard, "product_id"), present(products, "product_id")),
    ]
    return reduce(DataFrame.unionAll, checks)
