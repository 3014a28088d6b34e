"""Boundary, null and tie cases of every rule, on small hand-written frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from marketloom.contracts import BRONZE, SILVER, conform, contract_report, file_schema
from marketloom.functions import clean, derive, exact, scoring
from marketloom.operators.dedup import latest_per_key
from marketloom.operators.quality import drop_all_null, drop_report, require, row_counts
from marketloom.operators.ranking import rank_by_level
from marketloom.plans import golden, marts, silver

TS = dt.datetime(2001, 8, 2, tzinfo=dt.timezone.utc)
AS_OF = dt.date(2001, 8, 2)


def apply(spark, function, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in frame.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = [
    (clean.title_case, ["  ann lee ", "BrandA", "mary-jane", "CAPE  verde", "\tx", None],
     ["Ann Lee", "Branda", "Mary-jane", "Cape  Verde", "\tx", None]),
    (clean.lower_trim, [" A@B.CO ", None], ["a@b.co", None]),
    (clean.gender, ["M", "m", " M", "F", "f", "male", None],
     ["Male", "Male", "M", "Female", "Female", "Male", None]),
    (clean.parse_date,
     ["2024-02-29", "2023-02-29", "2024-1-5", "2024-13-01", "2024-01-05 10:00:00", " 2024-01-05",
      "2024-01-05\n", "bad", "", None],
     [dt.date(2024, 2, 29)] + [None] * 9),
    (clean.nonneg_double, [None, "0", "49.99", "-1", "n/a", " 5 ", "-0.01"],
     [None, 0.0, 49.99, None, None, 5.0, None]),
    (clean.nonneg_int, ["4.0", " 4 ", "-1", "0", "99999999999", None], [None, 4, None, 0, None, None]),
    (clean.rating, [None, "0", "1", "3", "5", "6", "4.0", "five"],
     [None, None, 1, 3, 5, None, None, None]),
    (derive.valid_email, ["a@b.co", "a@b", "a b@c.de", "a@@b.co", "", None],
     [True, False, False, False, False, None]),
    (derive.valid_payment, ["cash", "paypal", "bank transfer", "credit card", "voucher", None],
     [True, True, True, True, False, None]),
    (derive.text_length, ["", "héllo", None], [0, 5, None]),
]


@pytest.mark.parametrize("function,values,expected", CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_text_rules(spark, function, values, expected):
    assert apply(spark, function, values) == expected


def test_labels(spark):
    prices = [None, 0.0, 49.99, 50.0, 199.99, 200.0]
    assert apply(spark, derive.price_tier, prices, "double") == [
        "Unknown", "Low", "Low", "Medium", "Medium", "High"]
    assert apply(spark, derive.sentiment, [None, 1, 2, 3, 4, 5], "int") == [
        None, "negative", "negative", "neutral", "positive", "positive"]
    assert apply(spark, derive.in_stock, [None, 0, 1], "int") == [False, False, True]


def test_dates(spark):
    days = [dt.date(2024, 3, 9), None]
    assert apply(spark, clean.date_key, days, "date") == [20240309, None]
    assert apply(spark, clean.month_bucket, days, "date") == ["2024-03", None]
    assert apply(spark, lambda c: scoring.days_until(AS_OF, c), [dt.date(2001, 7, 31), None], "date") == [2, None]
    week = [dt.date(2001, 7, 29), dt.date(2001, 7, 30), dt.date(2001, 8, 5)]
    assert apply(spark, marts.week_start, week, "date") == [
        dt.date(2001, 7, 23), dt.date(2001, 7, 30), dt.date(2001, 7, 30)]


def test_scores(spark):
    assert apply(spark, scoring.recency_score, [30, 31, 60, 61, 90, 91, 180, 181, None], "int") == [
        5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert apply(spark, scoring.frequency_score, [1, 2, 4, 5, 9, 10, 19, 20, None], "bigint") == [
        1, 2, 2, 3, 3, 4, 4, 5, 1]
    spend = [99.99, 100.0, 499.99, 500.0, 999.99, 1000.0, 4999.99, 5000.0, None]
    assert apply(spark, scoring.monetary_score, spend, "double") == [1, 2, 2, 3, 3, 4, 4, 5, 1]
    assert apply(spark, scoring.segment, [15, 13, 12, 10, 9, 7, 6, 5, 4, 3], "int") == [
        "Champions", "Champions", "Loyal", "Loyal", "Potential Loyalist", "Potential Loyalist",
        "At Risk", "At Risk", "Hibernating", "Hibernating"]


# --- exact sums ----------------------------------------------------------

def _money(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    row = frame.agg(*exact.money_parts("x")).select(
        exact.money_total().alias("total"), exact.money_average().alias("average")).first()
    return row.total, row.average


def test_money(spark):
    assert _money(spark, [0.1] * 10) == (1.0, 0.1)
    assert _money(spark, [1.0, 1.01]) == (2.01, 1.01)  # 1.005 rounds up
    assert _money(spark, [None, None]) == (None, None)
    assert _money(spark, [5.0, None]) == (5.0, 5.0)


def test_money_keeps_odd_amounts(spark):
    assert _money(spark, [1.0, 0.125, 0.125]) == (1.25, 0.42)  # not whole cents
    assert _money(spark, [1e300, 1.0])[0] == 1e300
    assert math.isnan(_money(spark, [float("nan"), 1.0])[0])
    assert _money(spark, [float("inf"), 1.0]) == (float("inf"), float("inf"))


def test_ratio(spark):
    pairs = spark.createDataFrame([(201, 200), (1, 3), (2, 0), (None, 2), (-1, 8)], "n long, d long")
    assert [r[0] for r in pairs.select(exact.ratio("n", "d", 2)).collect()] == [1.01, 0.33, None, None, -0.13]
    assert [r[0] for r in pairs.limit(2).select(exact.percent("n", "d")).collect()] == [100.5, 33.3]


# --- operators -----------------------------------------------------------

def test_latest_per_key(spark):
    rows = [("a", 1, "old"), ("a", 2, "y"), ("a", 2, "x"), ("a", 2, None), ("b", None, "only"), (None, 3, "n1"), (None, 3, "n2")]
    frame = spark.createDataFrame(rows, "k string, t int, v string")
    expected = {("a", 2, None), ("b", None, "only"), (None, 3, "n1")}
    for partitions in (1, 5):
        got = latest_per_key(frame.repartition(partitions), ["k"], "t").collect()
        assert {tuple(r) for r in got} == expected and len(got) == 3


def test_newest_row_decides_even_if_incomplete(spark):
    rows = [("1", "n", "e@x.yz", None, None, None, dt.datetime(2020, 1, 1)),
            ("1", "n", None, None, None, None, dt.datetime(2020, 1, 2))]
    bronze = spark.createDataFrame(rows, BRONZE["customers"])
    assert silver.dim_customers(bronze, TS).count() == 0


def test_quality_rules(spark):
    frame = spark.createDataFrame([(None, None, 1), ("a", None, 2), ("b", "x", 3)], "k string, v string, t int")
    assert [r.t for r in drop_all_null(frame, ["k", "v"]).orderBy("t").collect()] == [2, 3]
    assert [r.t for r in require(frame, ["k", "v"]).collect()] == [3]
    assert tuple(drop_report(frame, "f", ["k", "v"]).first()) == ("f", 3, 1, 2)
    assert [tuple(r) for r in row_counts({"f": frame, "g": frame.limit(1)}).collect()] == [("f", 3), ("g", 1)]


def test_rank(spark):
    rows = [("a", 4.5), ("b", 4.5), ("c", 3.0), ("d", None), ("e", None), ("f", 1.0)]
    frame = spark.createDataFrame(rows, "id string, r double")
    got = {r.id: r.pos for r in rank_by_level(frame, "r", "pos").collect()}
    assert got == {"a": 1, "b": 1, "c": 3, "f": 4, "d": 5, "e": 5}


def test_lag_skips_missing_months(spark):
    rows = [("p", None, 1.0), ("p", "2024-01", 2.0), ("p", "2024-05", None), ("p", "2024-06", 3.33), ("q", "2024-01", 4.0)]
    frame = spark.createDataFrame(rows, "product_id string, review_month string, avg_rating double")
    got = golden.with_previous(frame, "product_id", "review_month", "avg_rating", "prev", "change")
    assert {(r.product_id, r.review_month, r.prev, r.change) for r in got.collect()} == {
        ("p", None, None, None), ("p", "2024-01", 1.0, 1.0), ("p", "2024-05", 2.0, None),
        ("p", "2024-06", None, None), ("q", "2024-01", None, None)}


def test_preferred_payment_ties_and_nulls(spark):
    rows = [("1", "a", "cash"), ("1", "b", "cash"), ("1", "c", "paypal"),
            ("2", "d", "paypal"), ("2", "e", "cash"),
            ("3", "f", None), ("3", "g", "cash"),
            ("4", "h", None), ("4", "i", None), ("4", "j", "cash")]
    orders = spark.createDataFrame(
        [(c, o, p, 1.0, AS_OF) for c, o, p in rows],
        "customer_id string, order_id string, payment_method string, total_amount double, order_date date")
    expected = {"1": "cash", "2": "cash", "3": "cash", "4": None}
    for function in (golden.preferred_payment, golden.customer_order_profile):
        assert {r.customer_id: r.preferred_payment for r in function(orders).collect()} == expected


def test_attention_flag(spark):
    def product(pid, stock):
        return (pid, "n", "c", 1.0, stock, "b", "Low", stock > 0, None, None)

    def reviews(pid, n, stars):
        return [(f"{pid}-{i}", pid, "1", stars, None, None, None, None, None, None) for i in range(n)]

    products = spark.createDataFrame(
        [product(p, s) for p, s in (("poor", 5), ("few", 5), ("gone", 0), ("good", 5), ("none", 5), ("unrated", 5))],
        SILVER["dim_products"])
    facts = spark.createDataFrame(
        reviews("poor", 5, 2) + reviews("few", 4, 2) + reviews("gone", 5, 2) + reviews("good", 5, 5)
        + reviews("unrated", 5, None), SILVER["fact_reviews"])
    got = {r.product_id: (r.review_count, r.rating_rank, r.needs_review_flag)
           for r in golden.product_performance(products, facts).collect()}
    assert got == {"poor": (5, 2, True), "few": (4, 2, False), "gone": (5, 2, False),
                   "good": (5, 1, False), "none": (0, 5, False), "unrated": (5, 5, None)}


def test_sales_flag_and_sentiment_order(spark):
    rows = [("a", 100.0, 700, 3.0), ("b", 100.0, 700, 3.3), ("c", 1.0, 1, 3.29), ("d", 1.0, 1, None), ("e", None, 9, None)]
    frame = spark.createDataFrame(
        [(i, "n", "c", p, n, r) for i, p, n, r in rows],
        "product_id string, product_name string, category string, price double, review_count long, avg_rating double")
    got = {r.product_id: r.sales_performance_flag for r in marts.sales_flag(frame).collect()}
    assert got == {"a": "High Sales, Low Rating", "b": "High Sales", "c": "Low Rating", "d": "Normal", "e": "Normal"}
    sentiment = spark.createDataFrame([("c", 1, 2, 3)], "category string, positive_count long, neutral_count long, negative_count long")
    assert [tuple(r) for r in marts.sentiment_total(sentiment).collect()] == [("Positive", 1), ("Neutral", 2), ("Negative", 3)]


def test_kpis_of_a_week_without_orders(spark):
    orders = spark.createDataFrame([("1", "9", dt.date(2001, 7, 25), 10.0)], "order_id string, customer_id string, order_date date, total_amount double")
    row = marts.kpi_week_vs_prev(orders, AS_OF).first()
    assert (row.current_orders, row.current_revenue, row.current_customers) == (0, None, 0)
    assert (row.previous_orders, row.previous_revenue, row.previous_aov, row.previous_customers) == (1, 10.0, 10.0, 1)


# --- contracts -----------------------------------------------------------

def test_conform(spark):
    frame = spark.createDataFrame([("x", 5)], "product_id string, stock_quantity long")
    contract = SILVER["dim_products"]
    with pytest.raises(ValueError, match="missing"):
        conform(frame, contract)
    with pytest.raises(ValueError, match="unexpected"):
        conform(frame.withColumn("extra", F.lit(1)), file_schema("products"))
    shuffled = spark.createDataFrame([], BRONZE["orders"]).select(*reversed(BRONZE["orders"].names))
    assert conform(shuffled, BRONZE["orders"]).columns == BRONZE["orders"].names


def test_contract_report_finds_faults(spark):
    frame = spark.createDataFrame([(None, "a"), ("1", "b")], "customer_id string, name string")
    lines = {r.column_name: r for r in contract_report(frame, "customers", BRONZE["customers"]).collect()}
    assert lines["customer_id"].null_violations == 1 and lines["customer_id"].type_ok
    assert lines["name"].null_violations == 0
    assert not lines["email"].type_ok and not lines["email"].position_ok
