"""Recency / frequency / monetary scores and the segment they lead to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.base import as_col, ladder

# Score bands (bound, score) and segment floors (score, label).
RECENCY_DAYS = ((30, 5), (60, 4), (90, 3), (180, 2))  # at most
FREQUENCY_ORDERS = ((20, 5), (10, 4), (5, 3), (2, 2))  # at least
MONETARY_SPEND = ((5000, 5), (1000, 4), (500, 3), (100, 2))  # at least
LOWEST_SCORE = 1
SEGMENTS = (
    (13, "Champions"),
    (10, "Loyal"),
    (7, "Potential Loyalist"),
    (5, "At Risk"),
)
LOWEST_SEGMENT = "Hibernating"


def days_until(as_of: dt.date, day: Column | str) -> Column:
    """Days from ``day`` to the caller's reference date."""
    return F.datediff(F.lit(as_of), as_col(day))


def recency_score(days: Column, bands=RECENCY_DAYS) -> Column:
    return ladder([(days <= bound, score) for bound, score in bands], LOWEST_SCORE)


def frequency_score(orders: Column, bands=FREQUENCY_ORDERS) -> Column:
    return ladder([(orders >= bound, score) for bound, score in bands], LOWEST_SCORE)


def monetary_score(spend: Column, bands=MONETARY_SPEND) -> Column:
    return ladder([(spend >= bound, score) for bound, score in bands], LOWEST_SCORE)


def segment(score: Column, floors=SEGMENTS) -> Column:
    return ladder([(score >= floor, label) for floor, label in floors], LOWEST_SEGMENT)
