"""One object that tells the operators which values belong to a domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from casemart import reference_values as ref
from casemart.functions.names import DISTRICT_RULES, NameRules, age_band, standardize_alias, standardize_name


@dataclass(frozen=True)
class CaseDomain:
    """Column spellings, alias tables, bands and the master list of places in scope."""

    case_columns: Mapping[str, Sequence[str]] = field(default_factory=lambda: ref.CASE_COLUMNS)
    population_columns: Mapping[str, Sequence[str]] = field(default_factory=lambda: ref.POPULATION_COLUMNS)
    districts: Sequence[str] = ref.DISTRICTS
    district_rules: NameRules = DISTRICT_RULES
    disease_aliases: Mapping[str, str] = field(default_factory=lambda: ref.DISEASE_ALIASES)
    sex_aliases: Mapping[str, str] = field(default_factory=lambda: ref.SEX_ALIASES)
    sex_labels: Mapping[str, str] = field(default_factory=lambda: ref.SEX_LABELS)
    age_bands: Sequence[tuple] = ref.AGE_BANDS
    month_labels: Sequence[str] = ref.MONTH_LABELS

    def district(self, value: Column) -> Column:
        return standardize_name(value, self.district_rules)

    def disease(self, value: Column) -> Column:
        return standardize_alias(value, self.disease_aliases)

    def sex(self, value: Column) -> Column:
        return standardize_alias(value, self.sex_aliases, default=F.lit(ref.SEX_UNKNOWN))

    def age_band(self, age: Column) -> Column:
        return age_band(age, self.age_bands)

    def in_scope(self, district: Column) -> Column:
        return district.isin(list(self.districts))
