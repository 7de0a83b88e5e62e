"""Ordered validation rules: the first failing rule names the reason, and rows split on it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.config import Settings
from casemart.domain import CaseDomain

REASON = "_quarantine_reason"


@dataclass(frozen=True)
class Rule:
    """`fails` is a boolean column; NULL counts as not failing."""

    reason: str
    fails: Column


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that fails, NULL when the row passes all of them."""
    return reduce(lambda chain, rule: chain.when(rule.fails, rule.reason), rules[1:], F.when(rules[0].fails, rules[0].reason))


def is_blank(column: str) -> Column:
    return F.coalesce(F.trim(column), F.lit("")) == ""


def outside(column: str, low: float, high: float) -> Column:
    return ~F.col(column).between(low, high)


def case_rules(settings: Settings, domain: CaseDomain) -> list[Rule]:
    """The case contract, in the order in which a reason is given."""
    return [
        Rule("invalid_year",
             F.col("year_be").isNull() | outside("year_be", settings.minimum_year_be, settings.maximum_year_be)),
        Rule("missing_disease_name", is_blank("disease_name_raw")),
        Rule("missing_district_name", is_blank("district_name_raw")),
        Rule("district_not_in_bangkok", ~domain.in_scope(domain.district(F.col("district_name_raw")))),
        Rule("invalid_case_count", ~(F.coalesce("case_count", F.lit(0.0)) > 0)),
        Rule("invalid_age", outside("age", 0, settings.maximum_age)),
        Rule("invalid_or_missing_report_date", F.isnull("report_date")),
    ]


def tag(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the reason column once. Store the result before splitting it, so that both sides read the column
    and neither evaluates the rules again."""
    return df.withColumn(REASON, first_failure(rules))


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.isnull(REASON)).drop(REASON)


def quarantined_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.isnotnull(REASON))


def reason_counts(tagged: DataFrame) -> DataFrame:
    """Rows per reason; at most one output row per rule.

    The rows without a reason drop out after grouping: a filter before it would be pushed below the
    rules and evaluate them a second time.
    """
    counted = tagged.groupBy(F.col(REASON).alias("reason")).agg(F.count(REASON).alias("rows"))
    return counted.where("rows > 0")


def keep_all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
