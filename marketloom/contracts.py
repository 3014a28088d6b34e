"""Table contracts: column names, order, types and NOT NULL rules per layer.

A contract is a plain ``StructType``.  ``conform`` brings a frame into that
shape before it is written, so a positional insert can never put a value into
the wrong column; ``contract_report`` measures how far a frame is from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published column lists of the twelve tables.  ``False`` means NOT NULL.
BRONZE = {
    "customers": (
        T.StructType()
        .add("customer_id", "string", False)
        .add("name", "string")
        .add("email", "string")
        .add("gender", "string")
        .add("signup_date", "string")
        .add("country", "string")
        .add("ingestion_date", "timestamp")
    ),
    "orders": (
        T.StructType()
        .add("order_id", "string", False)
        .add("customer_id", "string", False)
        .add("order_date", "string")
        .add("total_amount", "string")
        .add("payment_method", "string")
        .add("shipping_country", "string")
        .add("ingestion_date", "timestamp")
    ),
    "products": (
        T.StructType()
        .add("product_id", "string", False)
        .add("product_name", "string")
        .add("category", "string")
        .add("price", "string")
        .add("stock_quantity", "string")
        .add("brand", "string")
        .add("ingestion_date", "timestamp")
    ),
    "product_reviews": (
        T.StructType()
        .add("review_id", "string", False)
        .add("product_id", "string", False)
        .add("customer_id", "string", False)
        .add("rating", "string")
        .add("review_text", "string")
        .add("review_date", "string")
        .add("ingestion_date", "timestamp")
    ),
}

SILVER = {
    "dim_customers": (
        T.StructType()
        .add("customer_id", "string", False)
        .add("name", "string")
        .add("email", "string")
        .add("gender", "string")
        .add("signup_date", "date")
        .add("country", "string")
        .add("is_valid_email", "boolean")
        .add("ingestion_date", "timestamp")
        .add("silver_ts", "timestamp")
    ),
    "dim_products": (
        T.StructType()
        .add("product_id", "string", False)
        .add("product_name", "string")
        .add("category", "string")
        .add("price", "double")
        .add("stock_quantity", "integer")
        .add("brand", "string")
        .add("price_category", "string")
        .add("in_stock", "boolean")
        .add("ingestion_date", "timestamp")
        .add("silver_ts", "timestamp")
    ),
    "fact_orders": (
        T.StructType()
        .add("order_id", "string", False)
        .add("customer_id", "string", False)
        .add("order_date", "date")
        .add("order_date_key", "integer")
        .add("total_amount", "double")
        .add("payment_method", "string")
        .add("is_valid_payment", "boolean")
        .add("shipping_country", "string")
        .add("ingestion_date", "timestamp")
        .add("silver_ts", "timestamp")
    ),
    "fact_reviews": (
        T.StructType()
        .add("review_id", "string", False)
        .add("product_id", "string", False)
        .add("customer_id", "string", False)
        .add("rating", "integer")
        .add("review_text", "string")
        .add("review_length", "integer")
        .add("review_date", "date")
        .add("sentiment_bucket", "string")
        .add("ingestion_date", "timestamp")
        .add("silver_ts", "timestamp")
    ),
}

GOLDEN = {
    "agg_sales_summary": (
        T.StructType()
        .add("order_date_dt", "date")
        .add("shipping_country", "string")
        .add("total_orders", "long")
        .add("unique_customers", "long")
        .add("gross_revenue", "double")
        .add("avg_order_value", "double")
        .add("min_order_value", "double")
        .add("max_order_value", "double")
    ),
    "agg_product_performance": (
        T.StructType()
        .add("product_id", "string")
        .add("product_name", "string")
        .add("category", "string")
        .add("brand", "string")
        .add("price", "double")
        .add("price_category", "string")
        .add("in_stock", "boolean")
        .add("review_count", "long")
        .add("avg_rating", "double")
        .add("positive_reviews", "long")
        .add("neutral_reviews", "long")
        .add("negative_reviews", "long")
        .add("rating_rank", "integer")
        .add("needs_review_flag", "boolean")
    ),
    "agg_customer_360": (
        T.StructType()
        .add("customer_id", "string")
        .add("name", "string")
        .add("email", "string")
        .add("gender", "string")
        .add("country", "string")
        .add("signup_date", "date")
        .add("tenure_days", "integer")
        .add("total_orders", "long")
        .add("lifetime_value", "double")
        .add("avg_order_value", "double")
        .add("last_order_date", "date")
        .add("first_order_date", "date")
        .add("days_since_last_order", "integer")
        .add("reviews_written", "long")
        .add("avg_review_given", "double")
        .add("preferred_payment", "string")
        .add("recency_score", "integer")
        .add("frequency_score", "integer")
        .add("monetary_score", "integer")
        .add("rfm_score", "integer")
        .add("customer_segment", "string")
    ),
    "agg_review_sentiment": (
        T.StructType()
        .add("review_month", "string")
        .add("product_id", "string")
        .add("product_name", "string")
        .add("category", "string")
        .add("brand", "string")
        .add("total_reviews", "long")
        .add("avg_rating", "double")
        .add("positive_count", "long")
        .add("neutral_count", "long")
        .add("negative_count", "long")
        .add("positive_pct", "double")
        .add("negative_pct", "double")
        .add("prev_month_avg_rating", "double")
        .add("rating_mom_change", "double")
    ),
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "golden": GOLDEN}

AUDIT_COLUMNS = ("ingestion_date", "silver_ts")


def value_columns(contract: T.StructType) -> list[str]:
    """Columns that carry data, i.e. all but the audit timestamps."""
    return [f.name for f in contract if f.name not in AUDIT_COLUMNS]


def file_schema(table: str) -> T.StructType:
    """Reader schema of a landing file: the bronze contract without the audit column."""
    contract = BRONZE[table]
    return T.StructType([f for f in contract if f.name not in AUDIT_COLUMNS])


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select the contract's columns by name, in its order and types.

    Missing or unexpected columns are an error, found while planning and not
    after hours of writing.
    """
    missing = [n for n in contract.names if n not in df.columns]
    extra = [n for n in df.columns if n not in contract.names]
    if missing or extra:
        raise ValueError(f"frame does not fit its contract: missing {missing}, unexpected {extra}")
    have = {f.name: f.dataType for f in df.schema}
    return df.select(
        *[
            F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType)
            for f in contract
        ]
    )


def contract_report(df: DataFrame, table: str, contract: T.StructType) -> DataFrame:
    """One row per contract column: position, type match, NULLs found in NOT NULL columns.

    Types and order are known from the plan; the NULL counts of all required
    columns come from a single aggregate that reads only those columns.
    """
    actual = {f.name: (i, f.dataType) for i, f in enumerate(df.schema)}
    required = [f.name for f in contract if not f.nullable]
    if required:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    else:  # nothing to count, so the frame is not read
        nulls = df.sparkSession.range(1)
    lines = []
    for position, field in enumerate(contract):
        found = actual.get(field.name)
        lines.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(position + 1).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("declared_type"),
                F.lit(found is not None and found[1] == field.dataType).alias("type_ok"),
                F.lit(found is not None and found[0] == position).alias("position_ok"),
                (F.lit(0).cast("bigint") if field.nullable else F.col(field.name)).alias("null_violations"),
            )
        )
    return nulls.select(F.inline(F.array(*lines)))
