"""Numeric expressions shared by the indicator plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent_of(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, 0.0 when there is nothing to divide by."""
    whole = _col(whole)
    return F.when(whole > 0, F.round(_col(part) * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def mean_of_two(a: Column | str, b: Column | str, digits: int = 2) -> Column:
    """Rounded mean; NULL if either value is missing."""
    return F.round((_col(a) + _col(b)) / 2, digits)


def deflate(amount: Column | str, rate_percent: Column | str, digits: int = 2) -> Column:
    """Amount in constant prices.  ``rate_percent`` must already be rounded by the caller."""
    return F.round(_col(amount) / (1 + _col(rate_percent) / 100), digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def year_of_text(c: Column | str) -> Column:
    """Year of a date held as text; NULL if the text is no date."""
    return F.year(_col(c).try_cast("date"))


def truncate(c: Column | str) -> Column:
    """Drop the fraction, toward zero."""
    c = _col(c)
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("bigint")
