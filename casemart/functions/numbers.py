"""Numeric parsing and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemart.reference_values import BUDDHIST_OFFSET

# What is dropped from a number before it is read, and what then counts as one.
NUMBER_NOISE = r"[,\s\u00a0]+"
NUMBER_SHAPE = r"^(-?\d+(?:\.\d+)?)$"


def to_numeric(value: Column) -> Column:
    """Text such as `1,234` or ` 12.5 ` as double; anything else is NULL."""
    digits = F.regexp_replace(value.cast("string"), NUMBER_NOISE, "")
    return F.regexp_extract(digits, NUMBER_SHAPE, 1).try_cast("double")


def buddhist_year(value: Column) -> Column:
    """A common-era year (1900-2200) moved to the Buddhist calendar; other years stay as they are."""
    return to_buddhist(to_numeric(value).try_cast("int"))


def to_buddhist(year: Column) -> Column:
    """The calendar shift on a year that is already a number."""
    return year + F.when(year.between(1900, 2200), BUDDHIST_OFFSET).otherwise(0)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that answers NULL when the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def incidence(cases: Column, population: Column, per: int = 100_000, digits: int = 2) -> Column:
    """Rounded rate per `per` people, NULL unless the population is positive."""
    return F.when(population > 0, F.round(safe_ratio(cases, population) * F.lit(per), digits))


def case_share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of a whole."""
    return F.round(safe_ratio(part * F.lit(100.0), whole), digits)


def cumulative_rate(cases: Column, population: Column, digits: int = 2) -> Column:
    """Rounded cases per 100,000 over a period, scaled before dividing as the SQL views do."""
    scaled = cases * F.lit(100_000.0)
    return F.when(population > 0, F.round(safe_ratio(scaled, population), digits))
