"""Gapless series, agreement between tables, mergeable distinct counts: planted cases and edges."""

import contextlib
import datetime as dt
import io
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketloom.contracts import GOLDEN, SILVER
from marketloom.functions import exact
from marketloom.plans import consistency, reach, series
from marketloom.plans.refresh import RefreshReport
from marketloom.sources.ledger import RunLedger
from marketloom.sources.scratch import stored

SF_DIR = "/root/testdata/sf0.001"
MONDAY = dt.date(2024, 1, 1)


def week(n):
    return MONDAY + dt.timedelta(days=7 * n)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


# --- calendars -------------------------------------------------------------

def test_calendar_fills_gaps_per_group(spark):
    rows = [("a", week(0), 5), ("a", week(3), 7), ("b", week(2), 1), (None, week(1), 2), (None, week(2), 3), ("a", None, 99)]
    frame = spark.createDataFrame(rows, "g string, w date, n int")
    got = sorted(map(tuple, series.on_calendar(frame, ["g"], "w", "week", ["n"]).collect()), key=repr)
    assert got == sorted([
        ("a", week(0), 5, False), ("a", week(1), 0, True), ("a", week(2), 0, True), ("a", week(3), 7, False),
        ("b", week(2), 1, False), (None, week(1), 2, False), (None, week(2), 3, False)], key=repr)
    on = series.on_calendar(frame, ["g"], "w", "week", ["n"], until=week(4)).where("g = 'b'").orderBy("w").collect()
    assert [(r.w, r.n) for r in on] == [(week(2), 1), (week(3), 0), (week(4), 0)]
    early = series.on_calendar(frame, ["g"], "w", "week", ["n"], until=week(1)).where("g = 'b'").collect()
    assert [(r.w, r.n) for r in early] == [(week(2), 1)]
    assert series.on_calendar(frame.limit(0), ["g"], "w", "week", ["n"]).collect() == []


def test_calendar_of_days_and_months(spark):
    days = spark.createDataFrame([(dt.date(2024, 2, 28), 1.0), (dt.date(2024, 3, 1), 2.0)], "d date, x double")
    assert [(r.d, r.x) for r in series.on_calendar(days, [], "d", "day", ["x"]).orderBy("d").collect()] == [
        (dt.date(2024, 2, 28), 1.0), (dt.date(2024, 2, 29), 0.0), (dt.date(2024, 3, 1), 2.0)]
    months = spark.createDataFrame([(dt.date(2023, 12, 1), 1), (dt.date(2024, 3, 1), 2)], "m date, x int")
    assert [r.m for r in series.on_calendar(months, [], "m", "month", ["x"]).orderBy("m").collect()] == [
        dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]


def sales(spark, rows):
    frame = spark.createDataFrame(rows, "order_date_dt date, shipping_country string, total_orders long, gross_revenue double")
    return frame.withColumn("avg_order_value", F.col("gross_revenue") / F.col("total_orders"))


def test_an_empty_week_counts_as_the_week_before(spark):
    frame = sales(spark, [(week(0), "Peru", 2, 50.0), (week(2), "Peru", 1, 20.0), (week(2), "Chad", 1, None), (None, "Peru", 1, 9.0)])
    got = [tuple(r) for r in series.weekly_revenue_calendar(frame, week(3)).orderBy("shipping_country", "week_start").collect()]
    assert got == [
        ("Chad", week(2), 1, 0.0, None, None, None, False), ("Chad", week(3), 0, 0.0, 0.0, 0.0, None, True),
        ("Peru", week(0), 2, 50.0, None, None, None, False), ("Peru", week(1), 0, 0.0, 50.0, -50.0, -100.0, True),
        ("Peru", week(2), 1, 20.0, 0.0, 20.0, None, False), ("Peru", week(3), 0, 0.0, 20.0, -20.0, -100.0, True)]


# --- anomalies ---------------------------------------------------------------

def plain_flags(values, trailing=8, least=4, outstanding=3.5):
    out = []
    for i, x in enumerate(values):
        before = [v for v in values[max(0, i - trailing):i] if v is not None]
        if x is None or len(before) < least:
            out.append(None)
            continue
        middle = statistics.median(before)
        spread = statistics.median(abs(v - middle) for v in before)
        out.append(x != middle if spread == 0 else abs(round((x - middle) / (1.4826 * spread), 4)) > outstanding)
    return out


def test_anomalies_against_plain_medians(spark):
    draw = random.Random(4)
    noisy = [100 + draw.gauss(0, 5) for _ in range(40)]
    noisy[25], noisy[33] = 400.0, 2.0
    given = {
        "noisy": noisy,
        "constant": [7.0] * 12 + [7.5] + [7.0] * 8,
        "ties": [float(i % 2) for i in range(20)],
        "gaps": [None if i % 3 == 0 else float(i) for i in range(30)],
        "short": [1.0, 2.0, 900.0],
        "nulls": [None] * 10,
    }
    rows = [(name, i, x) for name, values in given.items() for i, x in enumerate(values)]
    frame = spark.createDataFrame(rows, "metric string, n int, value double").repartition(7)
    got = {}
    for r in series.flag_anomalies(frame, ["metric"], "n", "value").orderBy("metric", "n").collect():
        got.setdefault(r.metric, []).append(r.is_anomaly)
    assert got == {name: plain_flags(values) for name, values in given.items()}
    assert got["noisy"][25] and got["noisy"][33], "the planted spikes are found"
    assert got["constant"][12] and got["constant"][4:12] == [False] * 8
    assert got["short"] == [None] * 3 and got["nulls"] == [None] * 10


def test_a_spike_in_weekly_revenue_is_found(spark):
    frame = sales(spark, [(week(i), "Peru", 10, 1000.0 + 10 * (i % 3) + (50_000 if i == 20 else 0)) for i in range(30)])
    orders = spark.createDataFrame([(week(i), True) for i in range(30) for _ in range(3)], "order_date date, is_valid_payment boolean")
    reviews = spark.createDataFrame([(week(i),) for i in range(30)], "review_date date")
    found = series.weekly_anomalies(frame, orders, reviews, week(29)).collect()
    assert [(r.metric, r.week_start) for r in found if r.is_anomaly] == [("gross_revenue", week(20))]
    assert max(r.week_start for r in found) == week(28), "the running week is not judged"


def test_a_run_with_far_fewer_rows_stands_out(spark, tmp_path):
    ledger = RunLedger(spark, str(tmp_path))
    for n in range(9):
        report = RefreshReport({"silver.fact_orders": 40 if n == 7 else 1000 + n % 3, "silver.dim_products": 20})
        when = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=7 * n)
        if n == 5:
            ledger.record(f"w{n}", RefreshReport({"silver.fact_orders": 1}), when, week(n), OSError("lost"))
        ledger.record(f"w{n}", report, when, week(n))
    found = series.run_anomalies(ledger.read()).collect()
    assert [(r.run_id, r.table_name, r.rows_written) for r in found if r.is_anomaly] == [("w7", "silver.fact_orders", 40)]
    assert len(found) == 18 and sum(r.is_anomaly is None for r in found) == 8


# --- trend and forecast --------------------------------------------------------

def test_trend_of_products_and_categories(spark):
    def reviews(product, *stars):
        return [(f"{product}{i}", product, s, dt.date(2023 + i // 12, i % 12 + 1, 5)) for i, s in enumerate(stars)]

    rows = reviews("up", 1, 2, 3, 4, 5) + reviews("down", 5, 4, 4, 3) + reviews("flat", *[3] * 13) + reviews("lone", 4)
    rows += [("x", "same", 1, dt.date(2023, 1, 1)), ("y", "same", 5, dt.date(2023, 1, 31))]
    rows += [("z", "dead", None, dt.date(2023, 1, 1)), ("q", "dead", 3, None)]
    facts = spark.createDataFrame(rows, "review_id string, product_id string, rating int, review_date date")
    products = spark.createDataFrame(
        [("up", "n", "c", "b"), ("down", "n", "c", "b"), ("flat", "n", "d", "b")], "product_id string, product_name string, category string, brand string")
    got = {(r.level, r.key_value): r for r in series.sentiment_trend(facts, products).collect()}
    moves = {k: (r.slope, r.direction) for k, r in got.items()}
    assert moves["product", "up"] == (1.0, "improving") and moves["product", "down"] == (-0.6, "declining")
    assert moves["product", "flat"] == (0.0, "steady")
    assert moves["product", "lone"] == (None, None) and moves["product", "same"] == (None, None)
    assert ("product", "dead") not in got
    months = [0, 1, 2, 3, 4, 0, 1, 2, 3]
    stars = [1, 2, 3, 4, 5, 5, 4, 4, 3]
    assert got["category", "c"].slope == round(statistics.linear_regression(months, stars).slope, 6)
    assert (got["product", "flat"].first_month, got["product", "flat"].last_month) == ("2023-01", "2024-01")
    assert got["category", None].rated_reviews == 3


def plain_holt(values, horizon, alpha=0.3, beta=0.1):
    level, trend = values[0], 0.0
    for x in values[1:]:
        new = alpha * x + (1 - alpha) * (level + trend)
        trend = beta * (new - level) + (1 - beta) * trend
        level = new
    return [round(level + (h + 1) * trend, 2) for h in range(horizon)]


@pytest.mark.parametrize("values", [[5.0], [5.0, 5.0, 5.0], [float(10 + 3 * i) for i in range(200)], [1.0, -7.0, 22.5, 0.0]])
def test_forecast_against_a_plain_fold(spark, values):
    frame = spark.createDataFrame([(MONDAY + dt.timedelta(days=i), x) for i, x in enumerate(values)], "d date, x double").repartition(5)
    got = series.holt_forecast(frame, "d", "x", 10).orderBy("step").collect()
    assert [r.d for r in got] == [MONDAY + dt.timedelta(days=len(values) + i) for i in range(10)]
    assert [r.forecast for r in got] == pytest.approx(plain_holt(values, 10), abs=0.011)
    assert series.holt_forecast(frame.limit(0), "d", "x").collect() == []


# --- distinct customers ----------------------------------------------------------

def test_dense_numbers(spark):
    keys = spark.createDataFrame([(f"c{i % 500}",) for i in range(2000)] + [(None,)], "k string").repartition(5)
    got = reach.dense_numbers(keys, "k", "n").collect()
    assert sorted(r.n for r in got) == list(range(1, 501)) and len({r.k for r in got}) == 500
    again = reach.dense_numbers(keys.distinct().repartition(2), "k", "n").collect()
    assert sorted(got) == sorted(again), "the same keys get the same numbers"


def test_bitmaps_of_days_add_up(spark):
    """More customers than one bitmap holds, a customer with a third of all orders, undated orders."""
    orders = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 40_000)).alias("customer_id"),
        F.when(F.col("id") % 100 != 0, F.date_add(F.lit(MONDAY), (F.col("id") % 45).cast("int"))).alias("order_date"),
    )
    numbers = stored(reach.dense_numbers(orders, "customer_id", "customer_number"))
    bitmaps = stored(reach.daily_customer_bitmaps(orders, numbers))
    assert bitmaps.select(F.max("bitmap_bucket")).first()[0] >= 1
    assert {r[0] for r in bitmaps.select(F.octet_length("bitmap")).distinct().collect()} == {reach.BITMAP_BYTES}
    got = {(r.period_kind, r.period_start): r.customers for r in reach.customers_by_period(bitmaps).collect()}
    dated = orders.where("order_date IS NOT NULL")
    for kind, start in (("day", "order_date"), ("week", F.trunc("order_date", "week")), ("month", F.trunc("order_date", "month"))):
        want = dated.groupBy(F.col(start) if isinstance(start, str) else start).agg(F.count_distinct("customer_id")).collect()
        assert {d: n for (k, d), n in got.items() if k == kind} == {r[0]: r[1] for r in want}


# --- consistency -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tables(spark):
    layers = entry.Layers(spark, SF_DIR, store_silver=True)
    built = {name: layers(entry.CARDS if name == "agg_product_performance" else name) for name in (*SILVER, *GOLDEN)}
    return {name: df if name in SILVER else stored(df, name) for name, df in built.items()}


def lines(tables):
    return {(r.check_name, r.left_table, r.right_table, r.key_name): r for r in consistency.consistency_report(tables).collect()}


def test_tables_of_one_run_agree(tables):
    report = lines(tables)
    assert len(report) == 11
    assert all(r.consistent for k, r in report.items() if k[0] != "orphans")
    planted = report["orphans", "fact_reviews", "dim_products", "product_id"]
    assert not planted.consistent and planted.only_left > 0 and planted.left_total > planted.right_total


def test_planted_faults_are_found(spark, tables):
    def first(name, column):
        return tables[name].where(F.col(column) > 0).orderBy(*tables[name].columns[:3]).limit(1)

    broken = dict(tables)
    # one order moved between two customers: the total is the same
    two = tables["agg_customer_360"].where("total_orders > 1").orderBy("customer_id").limit(2).collect()
    shift = F.when(F.col("customer_id") == two[0].customer_id, 1).when(F.col("customer_id") == two[1].customer_id, -1).otherwise(0)
    broken["agg_customer_360"] = tables["agg_customer_360"].withColumn("total_orders", F.col("total_orders") + shift)
    broken["agg_sales_summary"] = tables["agg_sales_summary"].exceptAll(first("agg_sales_summary", "total_orders"))
    doubled = first("agg_review_sentiment", "total_reviews").withColumn("product_id", F.lit("new"))
    broken["agg_review_sentiment"] = tables["agg_review_sentiment"].unionByName(doubled)
    report = lines(broken)
    moved = report["orders", "agg_customer_360", "fact_orders", "customer_id"]
    assert (moved.differing, moved.left_total - moved.right_total, moved.consistent) == (2, 0, False)
    lost = report["orders", "agg_sales_summary", "fact_orders", "order_date_dt, shipping_country"]
    assert (lost.only_left, lost.only_right, lost.consistent) == (0, 1, False)
    assert not report["revenue_cents", "agg_sales_summary", "fact_orders", "order_date_dt, shipping_country"].consistent
    more = report["reviews", "agg_review_sentiment", "fact_reviews", "review_month, product_id"]
    assert (more.only_left, more.consistent) == (1, False)
    assert report["rows", "agg_customer_360", "dim_customers", "customer_id"].consistent


def test_a_hot_orphan_is_one_row_per_task(spark):
    """The key with most of the rows is added up before it is shuffled."""
    fact = spark.range(0, 100_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.lit("gone")).otherwise((F.col("id") % 50).cast("string")).alias("k"))
    dimension = spark.range(40).select(F.col("id").cast("string").alias("k"))
    found = consistency.orphans(fact.union(spark.createDataFrame([(None,)], "k string")), dimension, "k")
    assert {(r.k, r["rows"]) for r in found.collect()} >= {("gone", 66_666), (None, 1)}
    text = plan(found)
    assert text.index("Exchange hashpartitioning(k") > 0 and "partial_count" in text
    assert "LeftAnti" in text and "NestedLoop" not in text
    shuffled = [line for line in text.splitlines() if "Exchange hashpartitioning(k" in line]
    below = text.splitlines()[text.splitlines().index(shuffled[0]) + 1]
    assert "HashAggregate" in below or len(shuffled) > 1


# --- exact money -------------------------------------------------------------------

@pytest.mark.parametrize("amount, n", [(9e11, 100_000), (2e12, 100_000), (9e13, 1000), (8.5e16, 1000)])
def test_large_amounts_add_up_exactly(spark, amount, n):
    total = spark.range(0, n, 1, 8).select(F.lit(amount).alias("x")).agg(*exact.money_parts("x")).select(
        exact.money_total().alias("t"), exact.money_average().alias("a")).first()
    assert (total.t, total.a) == (float(int(amount) * n), amount)


def test_sums_do_not_depend_on_the_order(spark):
    draw = random.Random(8)
    amounts = [2e12, 0.01, -2e12, 1 / 3, 1e15 + 0.5, -1e15, 9e16, -9e16, 0.1 + 0.2, 123.45] * 50
    results = set()
    for parts in (1, 3, 8):
        draw.shuffle(amounts)
        frame = spark.createDataFrame([(x,) for x in amounts], "x double").repartition(parts)
        results.add(tuple(frame.agg(*exact.money_parts("x")).select(exact.money_total(), exact.money_average()).first()))
    assert len(results) == 1
    want = 50 * (0.01 + 0.3333333333 + 0.5 + 0.3 + 123.45)
    assert results.pop()[0] == pytest.approx(want, abs=0.006)


def test_odd_amounts(spark):
    def total(*xs):
        frame = spark.createDataFrame([(x,) for x in xs], "x double")
        return frame.agg(*exact.money_parts("x")).select(exact.money_total(), exact.money_average()).first()

    assert tuple(total(None)) == (None, None)
    assert tuple(total(None, 1.0, 2.0)) == (3.0, 1.5)
    assert math.isinf(total(float("inf"), 1.0)[0]) and math.isnan(total(float("nan"), 1.0)[0])
    assert total(1e300, 1.0)[0] == 1e300
    assert total(-0.01, -0.02)[0] == -0.03 and total(-5e11, 1.25)[0] == -499999999998.75


def test_tables_are_made_once_for_the_report(spark):
    """Every comparison reads stored tables, of the facts no text; nothing is built from raw frames twice."""
    agreeing = entry._agreeing(entry.Layers(spark, SF_DIR))
    for name, columns in consistency.COMPARED.items():
        assert agreeing[name].columns == list(columns)
    assert "review_text" not in agreeing["fact_reviews"].columns
    report = consistency.consistency_report(agreeing)
    read = set(report.inputFiles())
    assert read and not any(table in name for name in read for table in ("lineitem.parquet", "part.parquet"))
    scans = [line for line in plan(report).splitlines() if "FileScan" in line]
    assert sum("/fact_reviews-" in line for line in scans) == 1, "by product and month; the rest reads the counts"
    assert sum("/fact_orders-" in line for line in scans) == 2, "rows and revenue per day and country"
    for name in GOLDEN:
        assert {f.rsplit("/", 2)[1].split("-")[0] for f in agreeing[name].inputFiles()} == {name}
