"""Business labels and flags derived from cleaned columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.functions.base import as_col, ladder

# Rules and thresholds of the business labels.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PAYMENT_METHODS = ("bank transfer", "paypal", "cash", "credit card")
PRICE_TIERS = ((50, "Low"), (200, "Medium"))  # upper bounds, exclusive
PRICE_TOP_TIER = "High"
PRICE_MISSING = "Unknown"
POSITIVE, NEUTRAL, NEGATIVE = "positive", "neutral", "negative"
SENTIMENT_FLOORS = ((4, POSITIVE), (3, NEUTRAL))  # lower bounds, inclusive


def valid_email(email: Column | str) -> Column:
    return as_col(email).rlike(EMAIL_PATTERN)


def valid_payment(method: Column | str, allowed=PAYMENT_METHODS) -> Column:
    """Membership test; a NULL method stays NULL, it is not 'invalid'."""
    return as_col(method).isin(*allowed)


def in_stock(quantity: Column | str) -> Column:
    """An unknown quantity counts as out of stock."""
    return F.coalesce(as_col(quantity) > 0, F.lit(False))


def text_length(text: Column | str) -> Column:
    return F.length(as_col(text))


def price_tier(price: Column | str, tiers=PRICE_TIERS) -> Column:
    p = as_col(price)
    missing = [(p.isNull(), PRICE_MISSING)]
    return ladder(missing + [(p < bound, name) for bound, name in tiers], PRICE_TOP_TIER)


def sentiment(stars: Column | str, floors=SENTIMENT_FLOORS) -> Column:
    s = as_col(stars)
    unrated = [(s.isNull(), F.lit(None).cast("string"))]
    return ladder(unrated + [(s >= floor, name) for floor, name in floors], NEGATIVE)
