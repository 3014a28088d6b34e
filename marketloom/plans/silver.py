"""Raw all-text tables -> cleaned, typed, deduplicated tables.

Each table is described by its key, its required fields and one expression per
output column; ``refine`` turns that into a single pass: one shuffle on the
key, then a projection in the same stage.  The required-field rule runs after
deduplication: it judges the newest row of a key, and never lets an older row
stand in for it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.contracts import BRONZE, value_columns
from marketloom.functions import clean, derive
from marketloom.operators.dedup import latest_per_key
from marketloom.operators.quality import has_all, has_any


@dataclass(frozen=True)
class Refinement:
    source: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    columns: Callable[[], dict[str, Column]]


def _customer_columns() -> dict[str, Column]:
    email = clean.lower_trim("email")
    return {
        "customer_id": F.col("customer_id"),
        "name": clean.title_case("name"),
        "email": email,
        "gender": clean.gender("gender"),
        "signup_date": clean.parse_date("signup_date"),
        "country": clean.title_case("country"),
        "is_valid_email": derive.valid_email(email),
    }


def _product_columns() -> dict[str, Column]:
    price, stock = clean.nonneg_double("price"), clean.nonneg_int("stock_quantity")
    return {
        "product_id": F.col("product_id"),
        "product_name": clean.title_case("product_name"),
        "category": clean.title_case("category"),
        "price": price,
        "stock_quantity": stock,
        "brand": clean.title_case("brand"),
        "price_category": derive.price_tier(price),
        "in_stock": derive.in_stock(stock),
    }


def _order_columns() -> dict[str, Column]:
    day, method = clean.parse_date("order_date"), clean.lower_trim("payment_method")
    return {
        "order_id": F.col("order_id"),
        "customer_id": F.col("customer_id"),
        "order_date": day,
        "order_date_key": clean.date_key(day),
        "total_amount": clean.nonneg_double("total_amount"),
        "payment_method": method,
        "is_valid_payment": derive.valid_payment(method),
        "shipping_country": clean.title_case("shipping_country"),
    }


def _review_columns() -> dict[str, Column]:
    stars = clean.rating("rating")
    return {
        "review_id": F.col("review_id"),
        "product_id": F.col("product_id"),
        "customer_id": F.col("customer_id"),
        "rating": stars,
        "review_text": F.col("review_text"),
        "review_length": derive.text_length("review_text"),
        "review_date": clean.parse_date("review_date"),
        "sentiment_bucket": derive.sentiment(stars),
    }


REFINEMENTS = {
    "dim_customers": Refinement(
        "customers", ("customer_id",), ("customer_id", "email"), _customer_columns
    ),
    "dim_products": Refinement("products", ("product_id",), ("product_id",), _product_columns),
    "fact_orders": Refinement(
        "orders", ("order_id",), ("order_id", "customer_id"), _order_columns
    ),
    "fact_reviews": Refinement(
        "product_reviews",
        ("review_id",),
        ("review_id", "product_id", "customer_id"),
        _review_columns,
    ),
}


def latest(bronze: DataFrame, table: str) -> DataFrame:
    """Newest bronze row per key of the silver table ``table``."""
    spec = REFINEMENTS[table]
    ties = [c for c in value_columns(BRONZE[spec.source]) if c not in spec.key]
    return latest_per_key(bronze, spec.key, "ingestion_date", ties)


# Marks the rows that pass the quality rules, for a writer that counts the others.
KEPT = "_kept"


def _passes(table: str) -> Column:
    """All-null rule and required-field rule, on deduplicated rows."""
    spec = REFINEMENTS[table]
    return has_any(value_columns(BRONZE[spec.source])) & has_all(spec.required)


def _columns(table: str, run_ts: dt.datetime) -> list[Column | str]:
    typed = [expression.alias(name) for name, expression in REFINEMENTS[table].columns().items()]
    return [*typed, F.col("ingestion_date"), F.lit(run_ts).cast("timestamp").alias("silver_ts")]


def flagged(newest: DataFrame, table: str, run_ts: dt.datetime) -> DataFrame:
    """All deduplicated rows, typed, with the flag ``KEPT``."""
    return newest.select(*_columns(table, run_ts), _passes(table).alias(KEPT))


def refine(bronze: DataFrame, table: str, run_ts: dt.datetime) -> DataFrame:
    return latest(bronze, table).where(_passes(table)).select(*_columns(table, run_ts))


def dim_customers(bronze: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return refine(bronze, "dim_customers", run_ts)


def dim_products(bronze: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return refine(bronze, "dim_products", run_ts)


def fact_orders(bronze: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return refine(bronze, "fact_orders", run_ts)


def fact_reviews(bronze: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return refine(bronze, "fact_reviews", run_ts)
