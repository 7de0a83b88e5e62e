"""Population denominators: cleaning, yearly reference tables and carry-forward into years without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart import reference_values as ref
from casemart.config import Settings
from casemart.domain import CaseDomain
from casemart.functions import buddhist_year, standardize_name, to_numeric
from casemart.functions.names import DENOMINATOR_RULES
from casemart.operators.columns import find_column, quoted, required_column
from casemart.operators.rules import keep_all


def clean_population(raw: DataFrame, settings: Settings, domain: CaseDomain) -> DataFrame:
    """`year_be, district_name, population` with totals, blanks and impossible rows removed."""
    spelled = domain.population_columns
    year, district, people = (
        quoted(required_column(raw, spelled[name], f"population {name}"))
        for name in ("year", "district_name", "population")
    )
    named = raw.select(
        buddhist_year(year).alias("year_be"),
        domain.district(district).alias("district_name"),
        to_numeric(people).alias("population"),
    )
    usable = keep_all([
        F.col("year_be").between(settings.minimum_year_be, settings.maximum_year_be),
        F.trim("district_name") != "",
        F.col("population") > 0,
        ~F.col("district_name").rlike(ref.TOTAL_ROW_PREFIX),
    ])
    return (
        named.where(usable)
        .distinct()
        .groupBy("year_be", "district_name")
        .agg(F.sum("population").alias("population"))
    )


def carry_forward(population: DataFrame, cases: DataFrame) -> DataFrame:
    """Add the latest known denominators to every case year that has none, labelled in `filled`.

    The missing years form one small array (calendar years), which is exploded over the latest rows.
    """
    known = population.select("year_be").distinct()
    missing = cases.select("year_be").distinct().join(known, "year_be", "left_anti")
    latest = population.agg(F.max("year_be")).scalar()
    years = missing.agg(F.collect_set("year_be")).scalar()
    borrowed = (
        population.where(F.col("year_be") == latest)
        .select(F.explode(years).alias("year_be"), "district_name", "population")
    )
    return population.withColumn("filled", F.lit(False)).unionByName(borrowed.withColumn("filled", F.lit(True)))


def no_population(cases: DataFrame) -> DataFrame:
    """The typed empty denominator of cases-only mode."""
    schema = "year_be int, district_name string, population double, filled boolean"
    return cases.sparkSession.createDataFrame([], schema)


def yearly_reference(source: DataFrame, year_be: int, province: str = ref.CITY_PROVINCE) -> DataFrame:
    """One year's reference table out of an official file, narrowed to a province, summed per district.

    A file that states a year and has rows of another year, or of none, is not that year's reference: the query itself fails
    with the years it found.
    """
    spelled = ref.OFFICIAL_POPULATION_COLUMNS
    district = quoted(required_column(source, spelled["district_name"], "district"))
    people = quoted(required_column(source, spelled["population"], "population"))
    in_province = find_column(source, spelled["province"])
    local = source if in_province is None else source.where(quoted(in_province).contains(province))
    named = local.select(
        expected_year(source, year_be).alias("year_be"),
        standardize_name(district, DENOMINATOR_RULES).alias("district_name"),
        to_numeric(people).alias("population"),
    )
    name = F.col("district_name")
    usable = keep_all([
        F.col("year_be").isNotNull(),
        ~name.isin(list(ref.NO_DISTRICT_MARKS)),
        ~name.contains(ref.TOTAL_ROW_INFIX),
        ~F.lower(name).isin(list(ref.TOTAL_ROW_NAMES)),
        F.col("population") > 0,
    ])
    return (
        named.where(usable)
        .groupBy("year_be", "district_name")
        .agg(F.sum("population").cast("long").alias("population"))
    )


def official_year(source: DataFrame, year_be: int) -> Column:
    """The file's own year column where it has one, else the year it was asked for."""
    found = find_column(source, ref.OFFICIAL_POPULATION_COLUMNS["year"])
    return F.lit(year_be) if found is None else to_numeric(quoted(found)).try_cast("int")


def expected_year(source: DataFrame, year_be: int) -> Column:
    """The year of every row, or an error at run time that every result depends on. A file whose years are all missing passes without years."""
    if find_column(source, ref.OFFICIAL_POPULATION_COLUMNS["year"]) is None:
        return F.lit(year_be)
    stated = F.concat(F.coalesce(F.col("year_be").cast("string"), F.lit("none")), F.lit(" ("), F.col("rows").cast("string"), F.lit(" rows)"))
    others = foreign_years(source, year_be).orderBy("year_be").limit(20)
    found = others.agg(F.array_join(F.collect_list(stated), ", ")).scalar()
    any_year = source.agg(F.count(official_year(source, year_be))).scalar()
    message = F.concat(F.lit(f"expected the year {year_be}, found "), found)
    return F.when((found != "") & (any_year > 0), F.raise_error(message).cast("int")).otherwise(official_year(source, year_be))


def foreign_years(source: DataFrame, year_be: int) -> DataFrame:
    """Rows per year other than the expected one; a file with any of them is not that year's reference."""
    year = official_year(source, year_be)
    return (
        source.select(year.alias("year_be"))
        .where(~F.col("year_be").eqNullSafe(F.lit(year_be)))
        .groupBy("year_be").agg(F.count("*").alias("rows"))
    )
