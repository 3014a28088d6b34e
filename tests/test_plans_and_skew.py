"""Physical plans, and results under hot keys and different partitionings."""

import contextlib
import io
import re
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketloom.contracts import BRONZE, GOLDEN, SILVER, contract_report
from marketloom.operators.ranking import _ranges, rank_by_level
from marketloom.plans import golden, marts, silver
from retail_fixture import AS_OF, LOAD_TS
from marketloom.sources.scratch import stored

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def tables(spark):
    layers = entry.Layers(spark, SF_DIR)
    return {name: stored(layers(name), name) for name in SILVER}


@pytest.mark.parametrize("key", [k for k in entry.QUERIES if k.startswith(("silver_", "golden_", "dash_"))])
def test_no_python_in_the_plan(spark, key):
    text = plan(entry.queries()[key](spark, SF_DIR))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|NestedLoop", text)


def test_dedup_limits_before_the_shuffle(spark):
    for table, spec in silver.REFINEMENTS.items():
        text = plan(silver.latest(entry.Layers(spark, SF_DIR)(spec.source), table))
        assert text.count("WindowGroupLimit") == 2


def test_rank_leaves_many_values_in_many_tasks(spark):
    values = spark.range(0, 100_000, 1, 8).select("id", (F.rand(3) * 100 - 20).alias("v"))
    values = stored(values.union(spark.range(5).selectExpr("id", "cast(NULL AS double)")).union(spark.range(3).selectExpr("id", "0D")))
    ranked = rank_by_level(values, "v", "r")
    lines = plan(ranked).splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1 and re.search(r"HashAggregate\(keys=\[_range", lines[single[0] + 1]), "only ranges meet in one task"
    assert not any("BroadcastExchange" in line and "hint" in line for line in lines)
    want = values.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert ranked.exceptAll(want.select(*ranked.columns)).isEmpty()
    held = values.groupBy("v").count().groupBy(_ranges(F.col("v"))[0]).count().agg(F.max("count")).first()[0]
    assert held < 2_000, "no range holds many of the distinct values"


def test_rank_splits_values_that_crowd_in_one_range(spark):
    """Amounts of 1,000.00 to 1,001.99 have one power of two and leading digits; they still part."""
    crowded = spark.range(0, 20_000, 1, 8).select("id", (1000 + F.col("id") % 15_000 / 10_000).alias("v"))
    odd = [(-1, float("nan")), (-2, float("inf")), (-3, float("-inf")), (-4, None), (-5, 0.0), (-6, -0.0), (-7, -1e-300),
           (-8, 1e300), (-9, -1000.00001), (-10, -1000.00002), (-11, 5e-324)]
    values = stored(crowded.union(spark.createDataFrame(odd, "id long, v double")))
    ranked = rank_by_level(values, "v", "r")
    want = values.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert ranked.exceptAll(want.select(*ranked.columns)).isEmpty()
    levels = values.groupBy("v").count()
    first, *_ = ranges = _ranges(F.col("v"))
    assert levels.groupBy(first).count().agg(F.max("count")).first()[0] > 10_000
    assert levels.groupBy(*[r.alias(f"r{i}") for i, r in enumerate(ranges)]).count().agg(F.max("count")).first()[0] < 50


def test_rank_over_few_levels(spark):
    values = spark.range(3000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 400 / 100).alias("v"))
    few, many = (rank_by_level(values, "v", "r", few_levels=f) for f in (True, False))
    assert few.exceptAll(many.select(*few.columns)).isEmpty()


def test_reports_without_a_rank_do_not_make_one(spark):
    for key in ("top_bottom_products", "price_vs_rating", "stock_by_category", "needs_review_list", "unreviewed_products",
                "dash_estimated_sales", "dash_sales_flag"):
        assert "_level" not in plan(entry.queries()[key](spark, SF_DIR)), key


def test_contracts_without_required_columns_are_checked_from_the_schema(spark, tables):
    sales = golden.sales_summary(tables["fact_orders"])
    assert "FileScan" not in plan(contract_report(sales, "t", GOLDEN["agg_sales_summary"]))


def test_one_scan_for_sentiments_and_profile(spark, tables):
    sentiment = stored(golden.review_sentiment(tables["fact_reviews"], tables["dim_products"]))
    assert plan(marts.sentiment_by_category(sentiment)).count("FileScan") == 1
    assert plan(golden.customer_order_profile(tables["fact_orders"])).count("FileScan") == 1


def test_scans_read_only_what_they_need(spark, tables):
    text = plan(golden.customer_review_agg(tables["fact_reviews"]), "formatted")
    assert "ReadSchema: struct<review_id:string,customer_id:string,rating:int>" in text
    text = plan(marts.kpi_week_vs_prev(tables["fact_orders"], AS_OF), "formatted")
    assert "GreaterThanOrEqual(order_date,2001-07-23)" in text


def test_customer_360_joins_without_extra_shuffles(spark, tables):
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(golden.customer_360(
            tables["dim_customers"], tables["fact_orders"], tables["fact_reviews"], AS_OF))
    # customers; orders by customer+method, then by customer; reviews by customer
    assert text.count("Exchange hashpartitioning") == 4


def test_top_k_needs_no_full_sort(spark, tables):
    sales = stored(golden.sales_summary(tables["fact_orders"]))
    text = plan(marts.top_countries(sales))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


# --- properties ----------------------------------------------------------

def test_totals(tables):
    orders, reviews = tables["fact_orders"], tables["fact_reviews"]
    sales = golden.sales_summary(orders).agg(F.sum("total_orders")).first()[0]
    assert sales == orders.count()
    s = golden.review_sentiment(reviews, tables["dim_products"])
    total, labelled = s.agg(
        F.sum("total_reviews"), F.sum(F.expr("positive_count + neutral_count + negative_count"))).first()
    assert total == reviews.count() and labelled == reviews.where("sentiment_bucket is not null").count()
    low, high = golden.customer_360(
        tables["dim_customers"], orders, reviews, AS_OF).agg(F.min("rfm_score"), F.max("rfm_score")).first()
    assert 3 <= low <= high <= 15


def test_row_order_and_partitioning_do_not_matter(spark, tables):
    def results(frames):
        c, p, o, r = (frames[t] for t in SILVER)
        for df in (golden.sales_summary(o), golden.product_performance(p, r),
                   golden.customer_360(c, o, r, AS_OF), golden.review_sentiment(r, p)):
            yield Counter(map(repr, df.collect()))

    shuffled = {t: df.orderBy(F.rand(7)).repartition(13) for t, df in tables.items()}
    with conf(spark, spark__sql__shuffle__partitions="3", spark__sql__autoBroadcastJoinThreshold="-1"):
        other = list(results(shuffled))
    assert list(results(tables)) == other


@pytest.fixture(scope="module")
def hot(spark):
    """40% of all reviews and orders belong to one product and one customer; one id repeats 5,000 times."""
    owner = F.when(F.col("id") % 5 < 2, "hot").otherwise((F.col("id") % 900).cast("string"))
    reviews = spark.range(0, 50_000, 1, 16).select(
        F.when(F.col("id") < 5_000, "same").otherwise(F.col("id").cast("string")).alias("review_id"),
        owner.alias("product_id"), owner.alias("customer_id"),
        (F.col("id") % 5 + 1).cast("string").alias("rating"), F.lit("x").alias("review_text"),
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 200).cast("int")).cast("string").alias("review_date"),
        F.timestamp_seconds(F.col("id")).alias("ingestion_date"))
    orders = spark.range(0, 50_000, 1, 16).select(
        F.col("id").cast("string").alias("order_id"), owner.alias("customer_id"), F.lit("2001-08-01").alias("order_date"),
        F.concat((F.col("id") % 300).cast("string"), F.lit(".25")).alias("total_amount"),
        F.when(F.col("id") % 3 == 0, "cash").otherwise("paypal").alias("payment_method"),
        F.lit("peru").alias("shipping_country"), F.lit(LOAD_TS).cast("timestamp").alias("ingestion_date"))
    assert reviews.columns == BRONZE["product_reviews"].names and orders.columns == BRONZE["orders"].names
    return stored(reviews), stored(orders)


def test_hot_keys_keep_results_whole(spark, hot):
    raw_reviews, raw_orders = hot
    latest = silver.latest(raw_reviews, "fact_reviews")
    assert latest.count() == 45_001
    same = latest.where("review_id = 'same'").collect()
    assert len(same) == 1 and same[0].ingestion_date.timestamp() == 4_999
    reviews = stored(silver.fact_reviews(raw_reviews, LOAD_TS))
    orders = stored(silver.fact_orders(raw_orders, LOAD_TS))
    products = spark.createDataFrame(
        [("hot", "n", "c", "b")], "product_id string, product_name string, category string, brand string")
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
              spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
              spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
              spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB"):
        enriched = golden.reviews_enriched(reviews.repartition(16), products)
        rows = enriched.groupBy((F.col("category") == "c").alias("known")).count()
        found = {r.known: r["count"] for r in rows.collect()}
        enriched.collect()
        assert "skew=true" in plan(enriched)
    assert sum(found.values()) == 45_001
    assert found[True] == reviews.where("product_id = 'hot'").count()
    profile = golden.customer_order_profile(orders).where("customer_id = 'hot'").first()
    expected = raw_orders.where("customer_id = 'hot'").selectExpr(
        "count(*) AS n", "cast(sum(cast(total_amount AS decimal(10,2))) AS double) AS s").first()
    assert (profile.total_orders, profile.lifetime_value) == (expected.n, expected.s)
    assert profile.preferred_payment == "paypal"
    day = golden.sales_summary(orders).first()
    assert (day.total_orders, day.unique_customers) == (50_000, orders.select("customer_id").distinct().count())
