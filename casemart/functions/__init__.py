"""Column functions: Column in, Column out, built only from JVM-side expressions, safe under ANSI mode."""

from casemart.functions.numbers import (
    buddhist_year,
    case_share,
    cumulative_rate,
    incidence,
    safe_ratio,
    to_buddhist,
    to_numeric,
)
from casemart.functions.dates import (
    lineage_year,
    month_key,
    month_label,
    parse_report_date,
    shift_months,
    year_from_path,
)
from casemart.functions.names import (
    NameRules,
    age_band,
    alias_key,
    lookup,
    map_literal,
    standardize_alias,
    standardize_name,
)

__all__ = [
    "NameRules", "age_band", "alias_key", "buddhist_year", "case_share", "cumulative_rate", "incidence", "lineage_year",
    "lookup",
    "map_literal", "month_key", "month_label", "parse_report_date", "safe_ratio", "shift_months",
    "standardize_alias", "standardize_name", "to_buddhist", "to_numeric", "year_from_path",
]
