"""Declared constraints as queries: how many rows or keys break each one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.operators.star import FACT_KEY
from casemart.reference_values import BUDDHIST_OFFSET


@dataclass(frozen=True)
class TableContract:
    """Constraints of one table. `foreign` maps a column to (parent table, parent column)."""

    unique: Sequence[Sequence[str]] = ()
    required: Sequence[str] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)

    def only(self, kinds: Sequence[str]) -> "TableContract":
        """The same contract without the constraints of other kinds."""
        return TableContract(
            unique=self.unique if "UNIQUE" in kinds else (),
            required=self.required if "NOT NULL" in kinds else (),
            checks=self.checks if "CHECK" in kinds else {},
            foreign=self.foreign if "FOREIGN KEY" in kinds else {},
        )


STAR_CONTRACTS: dict[str, TableContract] = {
    "dim_date": TableContract(
        unique=(("date_key",), ("month_start",)),
        required=("date_key", "month_start", "year_be", "year_ce", "quarter", "month", "month_label"),
        checks={
            "quarter_range": "quarter between 1 and 4",
            "month_range": "month between 1 and 12",
            "year_offset": f"year_ce = year_be - {BUDDHIST_OFFSET}",
            "date_key_formula": "date_key = year_ce * 100 + month",
        },
    ),
    "dim_district": TableContract(
        unique=(("district_key",), ("district_name",)),
        required=("district_key", "district_name", "is_bangkok_district"),
    ),
    "dim_disease": TableContract(
        unique=(("disease_key",), ("disease_name",)), required=("disease_key", "disease_name")
    ),
    "dim_age_group": TableContract(
        unique=(("age_group_key",), ("age_group",)), required=("age_group_key", "age_group")
    ),
    "dim_sex": TableContract(
        unique=(("sex",),), required=("sex", "sex_label"), checks={"sex_code": "sex in ('M', 'F', 'U')"}
    ),
    "fact_disease_cases": TableContract(
        unique=(FACT_KEY,),
        required=(*FACT_KEY, "total_cases", "source_records"),
        checks={"cases_positive": "total_cases > 0", "records_positive": "source_records > 0"},
        foreign={
            "date_key": ("dim_date", "date_key"),
            "district_key": ("dim_district", "district_key"),
            "disease_key": ("dim_disease", "disease_key"),
            "age_group_key": ("dim_age_group", "age_group_key"),
            "sex": ("dim_sex", "sex"),
        },
    ),
    "fact_population": TableContract(
        unique=(("year_be", "district_key"),),
        required=("year_be", "district_key", "population"),
        checks={"population_positive": "population > 0"},
        foreign={"district_key": ("dim_district", "district_key")},
    ),
    "data_quality": TableContract(
        unique=(("layer", "rule"),),
        required=("layer", "rule", "status"),
        checks={"status_set": "status in ('PASS', 'FAIL', 'SKIP')"},
    ),
}


def result(table: str, kind: str, name: str, violations: Column) -> Column:
    counted = F.coalesce(violations, F.lit(0)).cast("long")
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(kind).alias("kind"), F.lit(name).alias("constraint_name"),
        counted.alias("violations"), F.when(counted == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def row_constraints(name: str, table: DataFrame, contract: TableContract) -> DataFrame:
    """NOT NULL and CHECK in one aggregate. A CHECK that is NULL holds, as in SQL."""
    missing = [result(name, "NOT NULL", column, F.count_if(F.isnull(column))) for column in contract.required]
    broken = [result(name, "CHECK", label, F.count_if(~F.expr(rule))) for label, rule in contract.checks.items()]
    return table.agg(F.array(*missing, *broken).alias("_results")).select(F.inline("_results"))


def key_constraint(name: str, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, plus rows whose key is not complete."""
    per_key = table.groupBy(*key).agg(F.count("*").alias("_copies"))
    incomplete = reduce(lambda a, b: a | b, [F.isnull(column) for column in key])
    bad = F.count_if((F.col("_copies") > 1) & ~incomplete) + F.coalesce(
        F.sum(F.when(incomplete, F.col("_copies"))), F.lit(0)
    )
    return per_key.agg(result(name, "UNIQUE", ", ".join(key), bad).alias("_result")).select("_result.*")


def reference_constraint(name: str, table: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference has no parent. Distinct references are matched, weighted by their rows."""
    references = table.where(F.isnotnull(column)).groupBy(column).agg(F.count("*").alias("_rows"))
    parents = parent.select(F.col(parent_column).alias(column))
    orphans = references.join(parents, column, "left_anti")
    return orphans.agg(result(name, "FOREIGN KEY", column, F.sum("_rows")).alias("_result")).select("_result.*")


KINDS = ("NOT NULL", "CHECK", "UNIQUE", "FOREIGN KEY")


def check_constraints(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, TableContract] = STAR_CONTRACTS,
    kinds: Sequence[str] = KINDS,
) -> DataFrame:
    """One row per constraint of the wanted kinds: table, kind, name, violations, status."""
    reports: list[DataFrame] = []
    for name, table in tables.items():
        contract = contracts.get(name, TableContract()).only(kinds)
        if contract.required or contract.checks:
            reports.append(row_constraints(name, table, contract))
        reports += [key_constraint(name, table, key) for key in contract.unique]
        reports += [
            reference_constraint(name, table, column, tables[parent], parent_column)
            for column, (parent, parent_column) in contract.foreign.items()
            if parent in tables
        ]
    return reduce(DataFrame.unionByName, reports)
