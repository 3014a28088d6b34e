"""Time series without gaps: calendars, anomalies, trends and a forecast.

All series are aggregated to one row per group and period first, so windows and folds run over rows
whose number is bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import exact
from marketloom.functions.base import ladder
from marketloom.plans import golden, marts
from marketloom.sources.ledger import SUCCEEDED

# One period back from a date, and the step between periods.
_PERIODS = {
    "day": (lambda day: F.date_sub(day, 1), "interval 1 day"),
    "week": (lambda day: F.date_sub(day, 7), "interval 7 days"),
    "month": (lambda day: F.add_months(day, -1), "interval 1 month"),
}

# Anomalies: trailing weeks looked at, the least of them that say anything, and the robust score from
# which a week stands out.  1.4826 times the median deviation estimates a standard deviation.
TRAILING, LEAST_HISTORY, OUTSTANDING, SPREAD = 8, 4, 3.5, 1.4826
# Stars per month from which a rating is moving.
MOVING = 0.01
# Weights of the newest value in the level and of the newest change in the trend; days ahead.
ALPHA, BETA, HORIZON = 0.3, 0.1, 14


def on_calendar(
    df: DataFrame, by: Sequence[str], period: str, unit: str, measures: Sequence[str], until: dt.date | None = None
) -> DataFrame:
    """Add a row with zeros for every period that a group skips between its first and its last.

    ``df`` has one row per group and ``period`` (a date on the grid of ``unit``: day, week or month).
    With ``until`` every group runs on to that period.  Each row spans the periods up to the next one
    of its group, so there is neither a join nor a second aggregation.  NULL periods are left out; an
    added row has ``is_filled`` true.
    """
    back, step = _PERIODS[unit]
    following = F.lead(period).over(Window.partitionBy(*by).orderBy(period))
    last = F.col(period) if until is None else F.greatest(F.col(period), F.lit(until))
    span = F.sequence(F.col(period), F.coalesce(back(following), last), F.expr(step))
    spread = df.where(F.col(period).isNotNull()).withColumn("_span", span)
    spread = spread.select(*by, *measures, F.posexplode("_span").alias("_at", period))
    filled = F.col("_at") > 0
    return spread.select(
        *by, period,
        *[F.when(filled, F.lit(0)).otherwise(F.col(m)).cast(df.schema[m].dataType).alias(m) for m in measures],
        filled.alias("is_filled"),
    )


def _monday(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def _cents(name: str) -> Column:
    return F.rint(F.col(name) * 100)


# --- calendars -------------------------------------------------------------

def weekly_revenue_calendar(sales: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders and revenue per country and week, compared with the week before on the calendar.

    Weeks without orders are there with zeros, from a country's first week to the week of ``as_of``.
    The change over a week of nothing has no percentage.
    """
    country, week = "shipping_country", "week_start"
    weekly = (
        sales.where(F.col("order_date_dt").isNotNull())
        .groupBy(country, marts.week_start("order_date_dt").alias(week))
        .agg(F.sum("total_orders").alias("orders"), *exact.money_parts("gross_revenue"))
        .select(country, week, "orders", F.coalesce(exact.money_total(), F.lit(0.0)).alias("gross_revenue"))
    )
    full = on_calendar(weekly, [country], week, "week", ["orders", "gross_revenue"], _monday(as_of))
    before = F.lag("gross_revenue").over(Window.partitionBy(country).orderBy(week))
    now, then = _cents("gross_revenue"), _cents("prev_revenue")
    return full.withColumn("prev_revenue", before).select(
        country, week, "orders", "gross_revenue", "prev_revenue",
        ((now - then) / 100).alias("revenue_change"), exact.percent(now - then, then).alias("change_pct"), "is_filled",
    )


def weekly_activity_calendar(orders: DataFrame, reviews: DataFrame, as_of: dt.date) -> DataFrame:
    """Orders, reviews and the share of known payment methods per calendar week, without gaps.

    A week without orders has no share.  Both tables are counted in one aggregation over their union;
    the window has no partition, but it runs over one row per week.
    """

    def dated(df: DataFrame, day: str, *flags: Column) -> DataFrame:
        return df.where(F.col(day).isNotNull()).select(marts.week_start(day).alias("week_start"), *flags)

    valid = F.coalesce(F.col("is_valid_payment"), F.lit(False))
    weekly = (
        dated(orders, "order_date", F.lit(True).alias("is_order"), valid.alias("is_valid"))
        .unionAll(dated(reviews, "review_date", F.lit(False), F.lit(False)))
        .groupBy("week_start")
        .agg(
            F.count_if("is_order").alias("order_count"),
            F.count_if(~F.col("is_order")).alias("review_count"),
            F.count_if("is_valid").alias("valid_orders"),
        )
    )
    counts = ["order_count", "review_count", "valid_orders"]
    full = on_calendar(weekly, [], "week_start", "week", counts, _monday(as_of))
    return full.select("week_start", *counts, exact.ratio("valid_orders", "order_count", 4).alias("valid_rate"), "is_filled")


def order_value_calendar(sales: DataFrame) -> DataFrame:
    """The dashboard's daily order value with a zero for every day without orders."""
    daily = marts.order_value_series(sales).where(F.col("order_date_dt").isNotNull())
    daily = daily.withColumn("total_order_value", F.coalesce("total_order_value", F.lit(0.0)))
    return on_calendar(daily, [], "order_date_dt", "day", ["total_order_value"])


def category_rating_calendar(reviews: DataFrame, products: DataFrame) -> DataFrame:
    """Average rating per category and calendar month, against the calendar month before.

    A month without ratings has no average, and the month after it no change.
    """
    per_product = reviews.groupBy("product_id", F.trunc("review_date", "month").alias("month_start")).agg(
        F.sum("rating").alias("stars"), F.count("rating").alias("rated")
    )
    monthly = (
        golden.reviews_enriched(per_product, products)
        .groupBy("category", "month_start")
        .agg(F.coalesce(F.sum("stars"), F.lit(0)).alias("stars"), F.sum("rated").alias("rated"))
    )
    full = on_calendar(monthly, ["category"], "month_start", "month", ["stars", "rated"])
    rated = full.select("category", "month_start", "rated", exact.ratio("stars", "rated", 2).alias("avg_rating"), "is_filled")
    before = F.lag("avg_rating").over(Window.partitionBy("category").orderBy("month_start"))
    return rated.withColumn("prev_avg_rating", before).withColumn(
        "rating_change", F.round(F.col("avg_rating") - F.col("prev_avg_rating"), 2)
    )


# --- anomalies ---------------------------------------------------------------

def _median(values: Column) -> Column:
    """Median of an array without NULLs; NULL for an empty one."""
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor((n + 2) / 2).cast("int")
    return F.when(n > 0, (F.element_at(ordered, F.greatest(low, F.lit(1))) + F.element_at(ordered, F.greatest(high, F.lit(1)))) / 2)


def flag_anomalies(
    series: DataFrame, by: Sequence[str], order: str, value: str,
    trailing: int = TRAILING, least: int = LEAST_HISTORY, outstanding: float = OUTSTANDING,
) -> DataFrame:
    """Mark values that stand out from the rows before them in their group.

    Added columns: ``trailing_median`` and ``trailing_mad`` (the median absolute deviation from it) of up
    to ``trailing`` rows before, ``score`` (distance from the median over 1.4826 times that deviation) and
    ``is_anomaly`` (score beyond ``outstanding`` either way).  Where the rows before are all alike or
    mostly tie, the deviation is 0 and there is no score: any other value is an anomaly, an equal one
    is not.  A NULL value, or fewer than ``least`` values before it, is not judged (NULL); NULLs before
    it are passed over.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(-trailing, -1)
    x, middle, spread = F.col(value), F.col("trailing_median"), F.col("trailing_mad")
    judged = x.isNotNull() & (F.size("_before") >= least)
    score = exact.rounded((x - middle) / (F.lit(SPREAD) * F.nullif(spread, F.lit(0.0))), 4)
    return (
        series.withColumn("_before", F.collect_list(value).over(before))
        .withColumn("trailing_median", _median(F.col("_before")))
        .withColumn("trailing_mad", _median(F.transform("_before", lambda y: F.abs(y - middle))))
        .withColumn("score", F.when(judged, score))
        .withColumn(
            "is_anomaly",
            F.when(judged & (spread == 0), x != middle).when(judged, F.abs("score") > outstanding),
        )
        .drop("_before")
    )


def weekly_anomalies(sales: DataFrame, orders: DataFrame, reviews: DataFrame, as_of: dt.date) -> DataFrame:
    """Weekly revenue, orders, reviews and share of known payment methods, with weeks that stand out.

    Gapless weeks that are over by ``as_of``; the running week is left out, since it is not comparable.
    """
    revenue = (
        sales.where(F.col("order_date_dt").isNotNull())
        .groupBy(marts.week_start("order_date_dt").alias("week_start"))
        .agg(*exact.money_parts("gross_revenue"))
        .select("week_start", F.coalesce(exact.money_total(), F.lit(0.0)).alias("value"))
    )
    until = _monday(as_of) - dt.timedelta(days=7)
    activity = weekly_activity_calendar(orders, reviews, until).select(
        "week_start", *[F.col(c).cast("double").alias(c) for c in ("order_count", "review_count", "valid_rate")]
    )
    long = activity.unpivot("week_start", ["order_count", "review_count", "valid_rate"], "metric", "value")
    every = on_calendar(revenue, [], "week_start", "week", ["value"], until).select(
        "week_start", F.lit("gross_revenue").alias("metric"), "value"
    )
    over = long.unionByName(every).where(F.col("week_start") <= F.lit(until))
    return flag_anomalies(over, ["metric"], "week_start", "value").select(
        "metric", "week_start", "value", "trailing_median", "trailing_mad", "score", "is_anomaly"
    )


def run_anomalies(records: DataFrame) -> DataFrame:
    """Runs of a ledger after which a table had far more or fewer rows than after the runs before.

    ``records`` are those of ``sources.ledger.RunLedger``; runs that failed are passed over.  A table's
    first runs are not judged.
    """
    done = records.where((F.col("status") == SUCCEEDED) & F.col("table_name").isNotNull())
    counts = done.select("run_id", "run_ts", "table_name", "rows_written", F.col("rows_written").cast("double").alias("value"))
    return flag_anomalies(counts, ["table_name"], "run_ts", "value").select(
        "run_id", "table_name", "rows_written", "trailing_median", "score", "is_anomaly"
    )


# --- trend -------------------------------------------------------------------

_MOMENTS = ("n", "t", "y", "tt", "ty")


def _slope() -> Column:
    """Least-squares slope from summed moments, exact up to one division; NULL below two months."""
    wide = {m: F.col(m).cast("decimal(38,0)") for m in _MOMENTS}
    over = wide["n"] * wide["tt"] - wide["t"] * wide["t"]
    under = (wide["n"] * wide["ty"] - wide["t"] * wide["y"]).cast("double")
    return exact.rounded(under / F.nullif(over.cast("double"), F.lit(0.0)), 6)


def sentiment_trend(reviews: DataFrame, products: DataFrame, moving: float = MOVING) -> DataFrame:
    """Is the rating of a product, or of a category, improving or declining?

    The slope (stars per month) of the least-squares line through all rated, dated reviews.  Reviews
    become five sums per product before the shuffle; sums of products add up to those of their
    category.  Reviews of fewer than two different months have no slope and no direction.  Reviews of
    unknown products form the category NULL.
    """
    month = (F.year("review_date") * 12 + F.month("review_date")).cast("long")
    stars = F.col("rating").cast("long")
    per_product = (
        reviews.where(F.col("rating").isNotNull() & F.col("review_date").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("n"), F.sum(month).alias("t"), F.sum(stars).alias("y"),
            F.sum(month * month).alias("tt"), F.sum(month * stars).alias("ty"),
            F.min("review_date").alias("first"), F.max("review_date").alias("last"),
        )
    )
    per_category = (
        golden.reviews_enriched(per_product, products)
        .groupBy("category")
        .agg(*[F.sum(m).alias(m) for m in _MOMENTS], F.min("first").alias("first"), F.max("last").alias("last"))
    )
    slope = F.col("slope")
    levels = [("product", per_product, "product_id"), ("category", per_category, "category")]
    return reduce(
        DataFrame.unionAll,
        [
            df.withColumn("slope", _slope()).select(
                F.lit(level).alias("level"), F.col(key).alias("key_value"), F.col("n").alias("rated_reviews"),
                F.date_format("first", "yyyy-MM").alias("first_month"), F.date_format("last", "yyyy-MM").alias("last_month"),
                "slope",
                F.when(slope.isNotNull(), ladder([(slope >= moving, "improving"), (slope <= -moving, "declining")], "steady"))
                .alias("direction"),
            )
            for level, df, key in levels
        ],
    )


# --- forecast ----------------------------------------------------------------

def holt_forecast(
    series: DataFrame, day: str, value: str, horizon: int = HORIZON, alpha: float = ALPHA, beta: float = BETA
) -> DataFrame:
    """(step, day, forecast): exponential smoothing with a trend, ``horizon`` days on from the last day.

    ``series`` has one row per day without gaps, so the fold over all of them is short.  The level starts
    at the first value and the trend at 0; then level = alpha * value + (1 - alpha) * (level + trend) and
    trend = beta * (new level - level) + (1 - beta) * trend.  A forecast is level + step * trend, in two
    digits.  No rows for an empty series.
    """
    days = series.agg(
        F.sort_array(F.collect_list(F.struct(F.col(day).alias("day"), F.col(value).alias("value")))).alias("days")
    ).where(F.size("days") > 0)

    def smoothed(state: Column, row: Column) -> Column:
        level = F.lit(alpha) * row["value"] + F.lit(1 - alpha) * (state["level"] + state["trend"])
        trend = F.lit(beta) * (level - state["level"]) + F.lit(1 - beta) * state["trend"]
        return F.struct(level.alias("level"), trend.alias("trend"))

    first = F.struct(F.element_at("days", 1)["value"].alias("level"), F.lit(0.0).alias("trend"))
    rest = F.slice("days", F.lit(2), F.greatest(F.size("days") - 1, F.lit(0)))
    state = days.select(
        F.aggregate(rest, first, smoothed).alias("state"), F.element_at("days", -1)["day"].alias("last"),
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"),
    )
    return state.select(
        "step", F.date_add("last", F.col("step")).alias(day),
        exact.rounded(F.col("state.level") + F.col("step") * F.col("state.trend"), 2).alias("forecast"),
    )


def order_value_forecast(sales: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The forecast line over the dashboard's daily order value."""
    return holt_forecast(order_value_calendar(sales), "order_date_dt", "total_order_value", horizon)
