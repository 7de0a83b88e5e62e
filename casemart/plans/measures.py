"""Thirteen measures over a star, evaluated for explicit filters and explicit groups.

`filters` maps a dimension column to the selected values; `by` lists the dimension columns to group by.
Filters and groups are all the context there is. How each measure reads that context:

* `population` sees years and places only, never disease, age or sex; several years add up;
* `incidence_per_100k` is NULL as soon as age or sex is filtered or grouped;
* `case_share` divides by the same selection without its age and sex parts;
* the two earlier-month measures drop every date filter and look one or twelve calendar months
  before the last selected month, so months without rows count as gaps and are not skipped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casemart.functions import safe_ratio, shift_months
from casemart.operators.ranking import dense_rank_desc
from casemart.operators.star import Star
from casemart.reference_values import COVERAGE_COMPLETE, COVERAGE_PARTIAL

Filters = Mapping[str, Sequence]

DIMENSIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "dim_date": ("date_key", ("date_key", "month_start", "year_be", "year_ce", "quarter", "month", "month_label")),
    "dim_district": ("district_key", ("district_key", "district_name", "is_bangkok_district")),
    "dim_disease": ("disease_key", ("disease_key", "disease_name")),
    "dim_age_group": ("age_group_key", ("age_group_key", "age_group", "min_age", "max_age")),
    "dim_sex": ("sex", ("sex", "sex_label")),
}
WITHOUT_DENOMINATOR = ("dim_age_group", "dim_sex")


def owner(column: str) -> str:
    """The dimension a context column belongs to."""
    for dimension, (_, columns) in DIMENSIONS.items():
        if column in columns:
            return dimension
    raise KeyError(f"{column} is not a dimension column")


@dataclass(frozen=True)
class Context:
    filters: Filters
    by: tuple[str, ...]

    @classmethod
    def of(cls, filters: Filters | None, by: Sequence[str]) -> "Context":
        return cls(dict(filters or {}), tuple(by))

    def dimensions(self) -> list[str]:
        """Dimensions that filter or group, in a fixed order."""
        touched = {owner(column) for column in (*self.filters, *self.by)}
        return [dimension for dimension in DIMENSIONS if dimension in touched]

    def groups(self, *dimensions: str) -> list[str]:
        return [column for column in self.by if owner(column) in dimensions]

    def without(self, *dimensions: str) -> "Context":
        """The same context with all filters and groups of some dimensions removed."""
        return Context(
            {column: values for column, values in self.filters.items() if owner(column) not in dimensions},
            tuple(column for column in self.by if owner(column) not in dimensions),
        )


def left_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on the shared groups; without groups the right side is one row of constants."""
    if keys:
        return left.join(right, list(keys), "left")
    return left.withColumns({name: right.select(name).scalar() for name in right.columns})


class Mart:
    """Measures over one star and its quality report."""

    def __init__(self, star: Star, quality: DataFrame | None = None):
        self.star = star
        self.quality = quality

    def selected(self, dimension: str, filters: Filters) -> DataFrame:
        """A dimension narrowed by the filters on its own columns."""
        table = getattr(self.star, dimension)
        for column, values in filters.items():
            if owner(column) == dimension:
                table = table.where(F.col(column).isin(list(values)))
        return table

    def slice(self, fact: DataFrame, context: Context, dimensions: Sequence[str] | None = None) -> DataFrame:
        """A fact reduced to the selection and widened by the group columns."""
        for dimension in context.dimensions() if dimensions is None else dimensions:
            key, _ = DIMENSIONS[dimension]
            groups = context.groups(dimension)
            members = self.selected(dimension, context.filters)
            if groups:
                fact = fact.join(members.select(key, *[g for g in groups if g != key]), key)
            elif any(owner(column) == dimension for column in context.filters):
                fact = fact.join(members.select(key), key, "left_semi")
        return fact

    def summed(self, value: str, context: Context, name: str) -> DataFrame:
        sliced = self.slice(self.star.fact_disease_cases, context)
        return sliced.groupBy(*context.by).agg(F.sum(value).alias(name))

    # -- sums ------------------------------------------------------------------------------------

    def total_cases(self, context: Context) -> DataFrame:
        return self.summed("total_cases", context, "total_cases")

    def source_records(self, context: Context) -> DataFrame:
        return self.summed("source_records", context, "source_records")

    def denominators(self, context: Context) -> DataFrame:
        """Population rows in the selected years and places, widened by the date and place groups."""
        groups = context.groups("dim_date")
        years = self.selected("dim_date", context.filters).select("year_be", *[g for g in groups if g != "year_be"])
        rows = self.star.fact_population.join(years.distinct(), "year_be", "inner" if groups else "left_semi")
        return self.slice(rows, context, ["dim_district"])

    def population(self, context: Context) -> DataFrame:
        groups = context.groups("dim_date", "dim_district")
        return self.denominators(context).groupBy(*groups).agg(F.sum("population").alias("population"))

    # -- ratios ----------------------------------------------------------------------------------

    def incidence_per_100k(self, context: Context) -> DataFrame:
        cases = self.total_cases(context)
        split = any(dimension in WITHOUT_DENOMINATOR for dimension in context.dimensions())
        if split:
            return cases.select(*context.by, F.lit(None).cast("double").alias("incidence_per_100k"))
        groups = context.groups("dim_date", "dim_district")
        rated = left_on(cases, self.population(context), groups)
        rate = safe_ratio(F.col("total_cases") * 100_000, F.col("population"))
        return rated.select(*context.by, rate.alias("incidence_per_100k"))

    def population_coverage(self, context: Context) -> DataFrame:
        groups, places = context.groups("dim_date", "dim_district"), context.groups("dim_district")
        in_scope = self.selected("dim_district", context.filters).where("is_bangkok_district")
        scope = in_scope.groupBy(*places).agg(F.count_distinct("district_key").alias("_scope"))
        covered = (
            self.denominators(context).join(in_scope.select("district_key"), "district_key", "left_semi")
            .groupBy(*groups).agg(F.count_distinct("district_key").alias("_covered"))
        )
        both = left_on(covered, scope, places)
        return both.select(*groups, safe_ratio(F.col("_covered"), F.col("_scope")).alias("population_coverage"))

    def groups_of(self, context: Context) -> DataFrame:
        """Every group of the selected dates and places, also those without a denominator."""
        dates, places = context.groups("dim_date"), context.groups("dim_district")
        in_time = self.selected("dim_date", context.filters).select(*dates).distinct()
        in_space = self.selected("dim_district", context.filters).select(*places).distinct()
        if dates and places:
            # Calendar groups are few, so each place unfolds one small array of them.
            calendar = in_time.agg(F.collect_list(F.struct(*dates))).scalar()
            return in_space.withColumn("_date", F.explode(calendar)).select("_date.*", *places)
        return in_time if dates else in_space

    def coverage_status(self, context: Context) -> DataFrame:
        """Whether all places in scope have a denominator; groups without any are not covered."""
        coverage = self.population_coverage(context)
        groups = context.groups("dim_date", "dim_district")
        if groups:
            coverage = self.groups_of(context).join(coverage, groups, "left")
        text = F.when(F.col("population_coverage") >= 1, COVERAGE_COMPLETE).otherwise(COVERAGE_PARTIAL)
        return coverage.withColumn("coverage_status", text).drop("population_coverage")

    def case_share(self, context: Context) -> DataFrame:
        wide = context.without(*WITHOUT_DENOMINATOR)
        whole = self.total_cases(wide).withColumnRenamed("total_cases", "_whole")
        both = left_on(self.total_cases(context), whole, wide.by)
        return both.select(*context.by, safe_ratio(F.col("total_cases"), F.col("_whole")).alias("case_share"))

    def district_rank(self, context: Context) -> DataFrame:
        """Dense rank of the selected places, most cases first.

        Grouped by place alone, places without cases rank last; grouped further, only places with cases
        in a group have a rank there.
        """
        others = [column for column in context.by if owner(column) != "dim_district"]
        totals = self.total_cases(context)
        if others:
            most_first = W.partitionBy(*others).orderBy(F.desc("total_cases"))
            return totals.select(*context.by, F.dense_rank().over(most_first).alias("district_rank"))
        places = self.selected("dim_district", context.filters).select(*context.by).distinct()
        ranked = dense_rank_desc(places.join(totals, list(context.by), "left"), "total_cases", "district_rank")
        return ranked.select(*context.by, "district_rank")

    # -- earlier months --------------------------------------------------------------------------

    def cases_months_before(self, context: Context, months: int, name: str) -> DataFrame:
        dates, others = context.groups("dim_date"), [c for c in context.by if owner(c) != "dim_date"]
        target = shift_months(F.max("month_start"), -months).alias("month_start")
        targets = self.selected("dim_date", context.filters).groupBy(
            *[F.col(c).alias(f"_at_{c}") for c in dates]
        ).agg(target)
        free = context.without("dim_date")
        history = self.slice(
            self.star.fact_disease_cases.join(self.star.dim_date.select("date_key", "month_start"), "date_key"), free
        ).groupBy("month_start", *others).agg(F.sum("total_cases").alias(name))
        earlier = history.join(targets, "month_start")
        if not context.by:
            return earlier.agg(F.sum(name).alias(name))
        return earlier.select(*[F.col(f"_at_{c}").alias(c) if c in dates else F.col(c) for c in context.by], name)

    def cases_previous_month(self, context: Context) -> DataFrame:
        return self.cases_months_before(context, 1, "cases_previous_month")

    def cases_same_month_last_year(self, context: Context) -> DataFrame:
        return self.cases_months_before(context, 12, "cases_same_month_last_year")

    def change(self, context: Context, months: int, name: str) -> DataFrame:
        """(cases in the context - cases in the earlier month) / cases in the earlier month.

        The first term covers the whole context, not only its last month, as the measure is defined;
        group by month for the usual month-over-month figure.
        """
        now = self.total_cases(context).withColumns({"_now": F.col("total_cases"), "_then": F.lit(None).cast("long")})
        then = self.cases_months_before(context, months, "_then").withColumn("_now", F.lit(None).cast("long"))
        groups = list(context.by)
        both = now.select(*groups, "_now", "_then").unionByName(then.select(*groups, "_now", "_then"))
        merged = both.groupBy(*groups).agg(F.sum("_now").alias("_now"), F.sum("_then").alias("_then"))
        difference = F.coalesce("_now", F.lit(0)) - F.col("_then")
        return merged.select(*groups, safe_ratio(difference, F.col("_then")).alias(name))

    def mom_change(self, context: Context) -> DataFrame:
        return self.change(context, 1, "mom_change")

    def yoy_change(self, context: Context) -> DataFrame:
        return self.change(context, 12, "yoy_change")

    # -- quality ---------------------------------------------------------------------------------

    def failed_rules(self, context: Context) -> DataFrame:
        failing: Column = F.count_if(F.col("status") == "FAIL")
        return self.quality.agg(failing.alias("failed_rules"))

    def measure(self, name: str, filters: Filters | None = None, by: Sequence[str] = ()) -> DataFrame:
        """Evaluate a measure by name."""
        if name not in MEASURES:
            raise KeyError(f"unknown measure {name}; known: {', '.join(MEASURES)}")
        return getattr(self, name)(Context.of(filters, by))


MEASURES = (
    "total_cases", "source_records", "population", "incidence_per_100k", "population_coverage", "coverage_status",
    "case_share", "district_rank", "cases_previous_month", "mom_change", "cases_same_month_last_year", "yoy_change",
    "failed_rules",
)
