"""Dates, years and months in two calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemart.reference_values import BUDDHIST_OFFSET, CASE_FILE_YEAR_PATTERN, MONTH_LABELS

# The day-first shape, the year-first shape and the year from which a date is read as Buddhist.
DAY_FIRST = r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})$"
YEAR_FIRST = r"^\d{4}([/-])\d{2}\1\d{2}"
BUDDHIST_FROM = 2400


def parse_report_date(value: Column) -> Column:
    """`d/M/yyyy` or `d-M-yyyy` in either calendar, else an ISO-like date at the start, else NULL.

    Either shape becomes ISO text for one cast. Formats are told apart by pattern, because a failed
    parse costs an exception per row, and there is no non-raising `make_date`.
    """
    text = F.trim(value.cast("string"))
    flipped = F.regexp_replace(text, DAY_FIRST, "$3-$2-$1")
    year = F.substring(flipped, 1, 4).try_cast("int")
    year_first = F.translate(F.regexp_extract(text, YEAR_FIRST, 0), "/", "-")
    is_day_first = flipped != text
    common_era = F.concat((year - BUDDHIST_OFFSET).cast("string"), F.substring(flipped, 5, 6))
    iso = F.when(is_day_first & (year > BUDDHIST_FROM), common_era).when(is_day_first, flipped).otherwise(year_first)
    return iso.try_cast("date")


def year_from_path(path: Column, pattern: str = CASE_FILE_YEAR_PATTERN) -> Column:
    """The year a file name carries, or NULL."""
    return F.regexp_extract(path, pattern, 1).try_cast("int")


def lineage_year(explicit: Column, file_year: Column, report_date: Column) -> Column:
    """Explicit year first, then the file's year, then the year of the report date."""
    return F.coalesce(explicit, file_year, F.year(report_date) + F.lit(BUDDHIST_OFFSET)).cast("int")


def month_key(date: Column) -> Column:
    """`yyyymm` as an integer."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def month_label(month: Column, year_be: Column, labels: Sequence[str] = MONTH_LABELS) -> Column:
    """Short month name and Buddhist year; NULL for a month outside 1-12."""
    names = F.array(*[F.lit(label) for label in labels])
    return F.concat(F.try_element_at(names, month.cast("int")), F.lit(" "), year_be.cast("string"))


def shift_months(month_start: Column, months: int) -> Column:
    return F.add_months(month_start, months)
