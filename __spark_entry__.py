"""Registered queries and the SQL they are checked against.

``queries()`` runs every operator over the whole parquet tables of a folder;
``oracle_sql()`` gives independent SQL with the same columns and rows.
"""

from __future__ import annotations

import functools
import importlib
import os
import sys
from collections.abc import Callable, Mapping
from functools import reduce

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from marketloom.contracts import (  # noqa: E402
    AUDIT_COLUMNS,
    BRONZE,
    GOLDEN,
    LAYERS,
    SILVER,
    contract_report,
)
from marketloom.functions import clean, derive  # noqa: E402
from marketloom.operators import quality  # noqa: E402
from marketloom.plans import consistency, golden, marts, reach, series, silver  # noqa: E402
from marketloom.plans.refresh import full_refresh  # noqa: E402
from marketloom.sources import landing  # noqa: E402
from marketloom.sources.ledger import RunLedger, run_history  # noqa: E402
from marketloom.sources.scratch import scratch_path, stored  # noqa: E402
from marketloom.sources.tables import PathStore  # noqa: E402
from retail_fixture import AS_OF, LOAD_TS, Bridge  # noqa: E402

# Product figures without the rank, for reports that do not read it.
CARDS = "product_cards"

# The dashboard's threshold (60000) is above every product of the test tables.
TEST_HIGH_SALES = 10000


class Layers:
    """The twelve tables over one folder of parquet tables, each built on first use."""

    def __init__(self, spark: SparkSession, folder: str, store_silver: bool = False):
        self.spark, self.folder, self.source = spark, folder, Bridge(spark, folder)
        self.store_silver = store_silver
        self._built: dict[str, DataFrame] = {}

    def __call__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._build(table)
        return self._built[table]

    def _build(self, table: str) -> DataFrame:
        if table in BRONZE:
            return self.source.bronze(table)
        if table in SILVER:
            refined = silver.refine(self(silver.REFINEMENTS[table].source), table, LOAD_TS)
            return stored(refined, table) if self.store_silver else refined
        if table == "agg_sales_summary":
            return golden.sales_summary(self("fact_orders"))
        if table == CARDS:
            return golden.with_attention(
                golden.product_scorecard(self("dim_products"), self("fact_reviews"))
            )
        if table == "agg_product_performance":
            return golden.product_performance(self("dim_products"), self("fact_reviews"))
        if table == "agg_customer_360":
            return golden.customer_360(
                self("dim_customers"), self("fact_orders"), self("fact_reviews"), AS_OF
            )
        return golden.review_sentiment(self("fact_reviews"), self("dim_products"))

    def landed(self, table: str) -> DataFrame:
        """The raw frame written as landing files and read back."""
        return landing.read_landing(self.spark, table, self.source.land_csv(table))


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionAll, list(frames))


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


def _timestamp_text(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


def _all_tables(t: Layers):
    """(name, frame, contract) of the twelve tables, for one job: counting needs no stored copies."""
    t = Layers(t.spark, t.folder)
    for layer, tables in LAYERS.items():
        for table, contract in tables.items():
            yield f"{layer}.{table}", t(table), contract


# --- sources and sinks ---------------------------------------------------

def bronze_csv_scan(t: Layers) -> DataFrame:
    frames = []
    for table in ("customers", "orders", "products"):
        raw = t.landed(table)
        frames.append(
            raw.select(
                F.lit(table).alias("table_name"),
                *[F.col(c).alias(f"value_{i}") for i, c in enumerate(raw.columns, 1)],
            )
        )
    return _union(frames)


def bronze_audit_column(t: Layers) -> DataFrame:
    raw = t("products").drop("ingestion_date")
    return landing.with_ingestion_date(raw, LOAD_TS).select(
        "product_id", "product_name", _timestamp_text("ingestion_date").alias("ingested_at")
    )


def table_overwrite_sink(t: Layers) -> DataFrame:
    store = PathStore(t.spark, scratch_path(t.spark, "tables"))
    store.overwrite("silver", "fact_orders", t("fact_orders"))
    return _no_audit(store.read("silver", "fact_orders"))


def contract_check(t: Layers) -> DataFrame:
    return _union(contract_report(df, name, contract) for name, df, contract in _all_tables(t))


def row_count_audit(t: Layers) -> DataFrame:
    # the rank does not change the number of products, so it is not made to count them
    cards = Layers(t.spark, t.folder)(CARDS)
    tables = {name: df for name, df, _ in _all_tables(t)}
    return quality.row_counts(tables | {"golden.agg_product_performance": cards})


def landing_file_audit(t: Layers) -> DataFrame:
    return _union(
        landing.landing_file_audit(t.landed(table))
        .agg(
            F.sum("row_count").alias("row_count"),
            F.bool_and(F.col("file_bytes") > 0).alias("all_files_filled"),
        )
        .select(F.lit(table).alias("table_name"), "row_count", "all_files_filled")
        for table in BRONZE
    )


# --- cleaning ------------------------------------------------------------

def _cleaned(t: Layers, table: str, key: str, columns: list[str], function) -> DataFrame:
    """(table_name, row_key, column_name, cleaned), from one scan of the table."""
    return (
        t(table)
        .select(F.col(key).alias("row_key"), *[function(c).alias(c) for c in columns])
        .unpivot("row_key", columns, "column_name", "cleaned")
        .select(F.lit(table).alias("table_name"), "row_key", "column_name", "cleaned")
    )


def clean_title_case(t: Layers) -> DataFrame:
    return _union(
        [
            _cleaned(t, "customers", "customer_id", ["name", "country"], clean.title_case),
            _cleaned(t, "products", "product_id", ["product_name", "category", "brand"], clean.title_case),
            _cleaned(t, "orders", "order_id", ["shipping_country"], clean.title_case),
        ]
    )


def clean_lower_trim(t: Layers) -> DataFrame:
    return _union(
        [
            _cleaned(t, "customers", "customer_id", ["email"], clean.lower_trim),
            _cleaned(t, "orders", "order_id", ["payment_method"], clean.lower_trim),
        ]
    )


def _keyed(t: Layers, sources, function, name: str) -> DataFrame:
    return _union(
        t(table).select(
            F.lit(table).alias("table_name"), F.col(key).alias("row_key"), function(c).alias(name)
        )
        for table, key, c in sources
    )


def parse_date(t: Layers) -> DataFrame:
    sources = [
        ("customers", "customer_id", "signup_date"),
        ("orders", "order_id", "order_date"),
        ("product_reviews", "review_id", "review_date"),
    ]
    return _keyed(t, sources, clean.parse_date, "parsed")


def cast_nonneg_double(t: Layers) -> DataFrame:
    sources = [("products", "product_id", "price"), ("orders", "order_id", "total_amount")]
    return _keyed(t, sources, clean.nonneg_double, "amount")


def _project(table: str, key: str, name: str, expression) -> Callable[[Layers], DataFrame]:
    return lambda t: t(table).select(key, expression().alias(name))


# --- quality -------------------------------------------------------------

def dq_drop_report(t: Layers) -> DataFrame:
    return _union(
        quality.drop_report(silver.latest(t(spec.source), table), table, spec.required)
        for table, spec in silver.REFINEMENTS.items()
    )


def freshness(t: Layers) -> DataFrame:
    return marts.freshness({name: t(name) for name in SILVER}).select(
        "table_name", _timestamp_text("last_run").alias("last_run")
    )


# --- agreement, records and rejects --------------------------------------

def _agreeing(t: Layers) -> Mapping[str, DataFrame]:
    """Silver and golden tables with the columns that are compared, each made and stored once; the
    scorecard without its rank."""
    t = Layers(t.spark, t.folder)
    tables = {}
    for name in SILVER:
        t._built[name] = tables[name] = stored(t(name).drop(*consistency.UNREAD), name)
    for name in GOLDEN:
        built = t(CARDS if name == "agg_product_performance" else name)
        tables[name] = stored(built.select(*consistency.COMPARED[name]), name)
    return tables


def run_history_query(t: Layers) -> DataFrame:
    """A run that fails, is repeated until it succeeds, and is asked for once more."""
    spark, paths = t.spark, {table: t.source.land_csv(table) for table in BRONZE}
    store = PathStore(spark, scratch_path(spark, "refreshed"))
    ledger = RunLedger(spark, scratch_path(spark, "ledger"))
    refresh = functools.partial(
        full_refresh, spark, store=store, load_ts=LOAD_TS, run_ts=LOAD_TS, as_of=AS_OF, allow_nulls=("bronze",),
        ledger=ledger, run_id="2001-W31",
    )
    try:
        refresh({k: v for k, v in paths.items() if k != "orders"})
    except FileNotFoundError:
        pass
    first = refresh(paths)
    if refresh(paths) != first:
        raise AssertionError("a run that has succeeded was repeated")
    return run_history(ledger.read()).drop("error")


def _split(t: Layers) -> list[tuple[str, DataFrame, DataFrame, DataFrame]]:
    """(table, all records, good rows, rejects) of landing folders with malformed records among the others."""
    out = []
    for table in BRONZE:
        path = t.source.land_csv(table)
        t.source.land_malformed(table, path)
        good, rejects, _ = landing.split_landing(t.spark, table, path, scratch_path(t.spark, "split"))
        out.append((table, landing.read_landing(t.spark, table, path), good, rejects))
    return out


def bronze_rejects(t: Layers) -> DataFrame:
    return _union(rejects.drop("source_file") for _, _, _, rejects in _split(t))


def landing_reconciliation(t: Layers) -> DataFrame:
    counted = [
        quality.row_counts({"records": records, "good_rows": good, "rejected_rows": rejects})
        .groupBy(F.lit(table).alias("landing_table"))
        .pivot("table_name", ["records", "good_rows", "rejected_rows"])
        .agg(F.sum("row_count"))
        for table, records, good, rejects in _split(t)
    ]
    return _union(counted).withColumn("reconciled", F.expr("records = good_rows + rejected_rows"))


def customers_by_period(t: Layers) -> DataFrame:
    numbers = reach.dense_numbers(t(ORDERS), "customer_id", "customer_number")
    return reach.customers_by_period(reach.daily_customer_bitmaps(t(ORDERS), numbers))


def _columns(table: str, *names: str) -> Callable[[Layers], DataFrame]:
    return lambda t: t(table).select(*names)


def _report(function, *tables: str) -> Callable[[Layers], DataFrame]:
    return lambda t: function(*[t(name) for name in tables])


SALES, PERFORMANCE = "agg_sales_summary", "agg_product_performance"
C360, SENTIMENT = "agg_customer_360", "agg_review_sentiment"
ORDERS, REVIEWS, PRODUCTS = "fact_orders", "fact_reviews", "dim_products"

QUERIES: dict[str, Callable[[Layers], DataFrame]] = {
    "bronze_csv_scan": bronze_csv_scan,
    "bronze_csv_multiline": lambda t: t.landed("product_reviews"),
    "bronze_audit_column": bronze_audit_column,
    "table_overwrite_sink": table_overwrite_sink,
    "contract_check": contract_check,
    "row_count_audit": row_count_audit,
    "landing_file_audit": landing_file_audit,
    "golden_preview": lambda t: marts.preview(t(SENTIMENT), ["product_id", "review_month"]),
    "clean_title_case": clean_title_case,
    "clean_lower_trim": clean_lower_trim,
    "clean_gender": _project("customers", "customer_id", "gender", lambda: clean.gender("gender")),
    "parse_date": parse_date,
    "date_key": _project(
        "orders", "order_id", "order_date_key", lambda: clean.date_key(clean.parse_date("order_date"))
    ),
    "cast_nonneg_double": cast_nonneg_double,
    "cast_nonneg_int": _project(
        "products", "product_id", "stock_quantity", lambda: clean.nonneg_int("stock_quantity")
    ),
    "cast_rating_range": _project(
        "product_reviews", "review_id", "rating", lambda: clean.rating("rating")
    ),
    "flag_valid_email": _project(
        "customers", "customer_id", "is_valid_email",
        lambda: derive.valid_email(clean.lower_trim("email")),
    ),
    "flag_valid_payment": _project(
        "orders", "order_id", "is_valid_payment",
        lambda: derive.valid_payment(clean.lower_trim("payment_method")),
    ),
    "flag_in_stock": _project(
        "products", "product_id", "in_stock",
        lambda: derive.in_stock(clean.nonneg_int("stock_quantity")),
    ),
    "review_length": _project(
        "product_reviews", "review_id", "review_length", lambda: derive.text_length("review_text")
    ),
    "price_tier": _project(
        "products", "product_id", "price_category",
        lambda: derive.price_tier(clean.nonneg_double("price")),
    ),
    "sentiment_bucket": _project(
        "product_reviews", "review_id", "sentiment_bucket",
        lambda: derive.sentiment(clean.rating("rating")),
    ),
    "month_bucket": _project(
        "product_reviews", "review_id", "review_month",
        lambda: clean.month_bucket(clean.parse_date("review_date")),
    ),
    "recency_tenure_days": _columns(C360, "customer_id", "days_since_last_order", "tenure_days"),
    "dq_drop_all_null": lambda t: quality.drop_all_null(
        t("customers").drop("ingestion_date"), ["name", "email", "gender", "signup_date", "country"]
    ),
    "dq_required_keys": lambda t: quality.require(
        t("customers").select("customer_id", "email"), ["customer_id", "email"]
    ),
    "dq_drop_report": dq_drop_report,
    **{f"silver_{name}": (lambda t, name=name: _no_audit(t(name))) for name in SILVER},
    "dedup_latest": lambda t: _no_audit(silver.latest(t("product_reviews"), REVIEWS)),
    "preferred_payment": _report(golden.preferred_payment, ORDERS),
    "rating_rank": lambda t: golden.rated_rank(
        golden.product_scorecard(t(PRODUCTS), t(REVIEWS)).select("product_id", "avg_rating")
    ),
    "rating_lag_mom": _columns(
        SENTIMENT, "product_id", "review_month", "avg_rating", "prev_month_avg_rating",
        "rating_mom_change",
    ),
    "golden_sales_summary": _columns(SALES, *GOLDEN[SALES].names),
    "product_review_agg": _report(golden.product_review_agg, REVIEWS),
    "customer_order_agg": _report(golden.customer_order_agg, ORDERS),
    "customer_review_agg": _report(golden.customer_review_agg, REVIEWS),
    "monthly_sentiment_agg": _report(golden.monthly_sentiment, REVIEWS, PRODUCTS),
    "sentiment_pct": lambda t: golden.with_sentiment_pct(
        golden.monthly_sentiment(t(REVIEWS), t(PRODUCTS))
    ).select("product_id", "review_month", "positive_pct", "negative_pct"),
    "golden_product_performance": _columns(PERFORMANCE, *GOLDEN[PERFORMANCE].names),
    "golden_customer_360": _columns(C360, *GOLDEN[C360].names),
    "reviews_enriched": lambda t: _no_audit(golden.reviews_enriched(t(REVIEWS), t(PRODUCTS))),
    "golden_review_sentiment": _columns(SENTIMENT, *GOLDEN[SENTIMENT].names),
    "rfm_recency": _columns(C360, "customer_id", "days_since_last_order", "recency_score"),
    "rfm_frequency": _columns(C360, "customer_id", "total_orders", "frequency_score"),
    "rfm_monetary": _columns(C360, "customer_id", "lifetime_value", "monetary_score"),
    "rfm_score": _columns(C360, "customer_id", "rfm_score"),
    "customer_segment": _columns(C360, "customer_id", "customer_segment"),
    "dash_top_countries": _report(marts.top_countries, SALES),
    "dash_order_value_series": _report(marts.order_value_series, SALES),
    "dash_aov_series": _report(marts.aov_series, SALES),
    "dash_sentiment_by_category": _report(marts.sentiment_by_category, SENTIMENT),
    "dash_sentiment_total": _report(marts.sentiment_total, SENTIMENT),
    "dash_segment_distribution": _report(marts.segment_counts, C360),
    "dash_estimated_sales": lambda t: marts.estimated_sales(t(CARDS)).select(
        "product_id", "price", "review_count", "estimated_sales"
    ),
    "dash_sales_flag": lambda t: marts.sales_flag(t(CARDS), TEST_HIGH_SALES),
    "sample_rows": lambda t: marts.preview(t(C360), ["customer_id"], 1000),
    "weekly_revenue_wow": _report(marts.weekly_revenue_wow, SALES),
    "revenue_by_country": _report(marts.revenue_by_country, SALES),
    "kpi_week_vs_prev": lambda t: marts.kpi_week_vs_prev(t(ORDERS), AS_OF),
    "orders_by_weekday": _report(marts.orders_by_weekday, SALES),
    "price_vs_rating": _report(marts.price_vs_rating, CARDS),
    "top_bottom_products": _report(marts.top_bottom_products, CARDS),
    "category_brand_heatmap": _report(marts.category_brand_heatmap, REVIEWS, PRODUCTS),
    "category_rating_trend": _report(marts.category_rating_trend, REVIEWS, PRODUCTS),
    "sentiment_split": _report(marts.sentiment_split, SENTIMENT),
    "needs_review_list": _report(marts.needs_review_list, CARDS),
    "segment_counts": _report(marts.segment_counts, C360),
    "customer_kpis": _report(marts.customer_kpis, C360),
    "ltv_by_segment": _report(marts.ltv_by_segment, C360),
    "champions_by_country": _report(marts.champions_by_country, C360),
    "payment_by_segment": _report(marts.payment_by_segment, C360),
    "recency_monetary_grid": _report(marts.recency_monetary_grid, C360),
    "reengagement_list": _report(marts.reengagement_list, C360),
    "weekly_orders_vs_reviews": _report(marts.weekly_orders_vs_reviews, ORDERS, REVIEWS),
    "valid_payment_rate": _report(marts.valid_payment_rate, ORDERS),
    "activation_rate": _report(marts.activation_rate, C360),
    "stock_by_category": _report(marts.stock_by_category, CARDS),
    "unreviewed_products": _report(marts.unreviewed_products, CARDS),
    "freshness": freshness,
    "consistency_report": lambda t: consistency.consistency_report(_agreeing(t)),
    "orphan_keys": lambda t: consistency.orphan_keys({name: t(name) for name in SILVER}),
    "run_history": run_history_query,
    "bronze_rejects": bronze_rejects,
    "landing_reconciliation": landing_reconciliation,
    "weekly_revenue_calendar": lambda t: series.weekly_revenue_calendar(t(SALES), AS_OF),
    "weekly_activity_calendar": lambda t: series.weekly_activity_calendar(t(ORDERS), t(REVIEWS), AS_OF),
    "order_value_calendar": _report(series.order_value_calendar, SALES),
    "category_rating_calendar": _report(series.category_rating_calendar, REVIEWS, PRODUCTS),
    "weekly_anomalies": lambda t: series.weekly_anomalies(t(SALES), t(ORDERS), t(REVIEWS), AS_OF),
    "sentiment_trend": _report(series.sentiment_trend, REVIEWS, PRODUCTS),
    "order_value_forecast": _report(series.order_value_forecast, SALES),
    "customers_by_period": customers_by_period,
}


def _runner(build: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(Layers(spark, sf_dir))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Top ten countries by revenue, from raw orders through all layers."""
    return queries()["dash_top_countries"](spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def _corpus_queries() -> tuple[dict[str, Callable], dict[str, str]]:
    """Queries and SQL of the training-data operators; none where that subpackage is not installed."""
    try:
        llm = importlib.import_module("marketloom.llm.queries")
        pipeline = importlib.import_module("corpus_pipeline")
    except ModuleNotFoundError as gone:
        if gone.name not in ("corpus_pipeline", "marketloom.llm", "marketloom.llm.queries"):
            raise
        return {}, {}
    named = {**llm.QUERIES, "pipeline": pipeline.run}
    sql = {**llm.ORACLE_SQL, "pipeline": pipeline.ORACLE_SQL}
    return (
        {name: _with_modules(query) for name, query in named.items()},
        {name: text for name, text in sql.items() if text},
    )


def _with_modules(query: Callable) -> Callable:
    """Let Python workers find the modules of this folder, from wherever the session was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in QUERIES.items()} | _corpus_queries()[0]


def oracle_sql() -> dict[str, str]:
    return oracle.all_sql() | _corpus_queries()[1]
