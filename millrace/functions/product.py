"""Product rules as column expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the product rules.
UNCATEGORIZED = "UNCATEGORIZED"
PRICE_TIERS = {"Budget": 50, "Standard": 100, "Premium": 500}  # tier: price below
TOP_TIER = "Luxury"
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
LAST_SEASON = "Fall"
SCORE_CENTRE, SCORE_PER_DEVIATION, SCORE_LOW, SCORE_HIGH = 50.0, 10.0, 0.0, 100.0
MIN_NAME_LENGTH = 3


def _first_match(choices: list[tuple[Column, str]], default: str) -> Column:
    (condition, label), *rest = choices
    chain = reduce(lambda c, pair: c.when(pair[0], F.lit(pair[1])), rest, F.when(condition, F.lit(label)))
    return chain.otherwise(F.lit(default))


def tidy_text(text: Column) -> Column:
    """Runs of white space become one space, ends are trimmed, words are capitalised."""
    single_spaced = F.regexp_replace(text, r"\s+", " ")
    return F.initcap(F.trim(single_spaced))


def price_tier(price: Column) -> Column:
    """Tier by upper bound; a null price is below no bound and lands in the top tier."""
    return _first_match([(price < bound, tier) for tier, bound in PRICE_TIERS.items()], TOP_TIER)


def season(day: Column) -> Column:
    """Season of the month; a null date matches no month and lands in the last season."""
    return _first_match([(F.month(day).isin(*months), name) for name, months in SEASONS.items()], LAST_SEASON)


def age_days(created: Column, as_of: dt.date | None = None) -> Column:
    """Whole days from ``created`` to ``as_of`` (today when not given)."""
    return F.datediff(F.lit(as_of) if as_of else F.current_date(), created)


def score_of(price: Column, mean: Column, deviation: Column) -> Column:
    """50 plus ten points per standard deviation, two decimals, held within 0..100.

    Every row scores 50 when the prices do not vary or there are none.
    """
    points = F.round(F.lit(SCORE_CENTRE) + (price.cast("double") - mean) / deviation * SCORE_PER_DEVIATION, 2)
    held = F.least(F.greatest(points, F.lit(SCORE_LOW)), F.lit(SCORE_HIGH))
    flat = deviation.isNull() | (deviation == 0)
    # greatest/least skip nulls, so a null price needs its own branch
    return F.when(flat, F.lit(SCORE_CENTRE)).when(price.isNotNull(), held)
