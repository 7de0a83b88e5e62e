"""The batch run: raw files to a published mart, one stored layer at a time."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.config import Layout, Settings
from casemart.domain import CaseDomain
from casemart.operators.cases import canonical_cases, standardized_cases
from casemart.operators.denominators import carry_forward, clean_population, no_population
from casemart.operators.gold import gold_table
from casemart.operators.identity import assign_case_id, keep_latest
from casemart.operators.quality import Layers, has_failure, quality_report
from casemart.operators.rules import case_rules, clean_rows, quarantined_rows, tag
from casemart.operators.star import build_star, stored_star
from casemart.plans.progress import Progress, fingerprint
from casemart.sinks.files import write_export, write_quality
from casemart.sinks.publish import current_mart, publish
from casemart.sources.catalog import chosen_files
from casemart.sources.files import read_case_files
from casemart.sources.paths import SourceNotFound, list_files
from casemart.sources.population import read_population


@dataclass(frozen=True)
class RunResult:
    """Rows of the published tables (none where the run was held back), whether a rule failed, and the layers: name, rows, and whether they were there already."""

    row_counts: dict[str, int]
    failed: bool
    layers: tuple[tuple[str, int | None, bool], ...] = ()


@dataclass(frozen=True)
class Input:
    """Raw rows, read only when a layer needs them, and a digest that changes when they do."""

    digest: str
    read: Callable[[], DataFrame]


def file_inputs(spark: SparkSession, layout: Layout, require_population: bool, multi_line: bool = True) -> tuple[Input, Input | None]:
    """The newest case file of every year, and all population files. Missing population is an error only if it is required."""
    chosen = chosen_files(spark, layout.raw_cases_glob)
    listed = list_files(spark, layout.raw_cases_glob)
    cases = Input(fingerprint(listed.where(F.col("path").isin(chosen))), lambda: read_case_files(spark, chosen, multi_line))
    try:
        population = read_population(spark, layout.raw_population_glob)
    except SourceNotFound:
        if require_population:
            raise
        return cases, None
    return cases, Input(fingerprint(list_files(spark, layout.raw_population_glob)), lambda: population)


def run_batch(
    spark: SparkSession,
    layout: Layout,
    settings: Settings | None = None,
    domain: CaseDomain | None = None,
    require_population: bool = True,
    publish_failed: bool = False,
    resume: bool = True,
    multi_line: bool = True,
) -> RunResult:
    """Read, validate, split, deduplicate, standardize, rate, build the star, check and publish the files of a layout.

    A run that breaks a quality rule isn't published unless `publish_failed` is given: the mart of the run before stays current, and the
    counts of the result are empty. `multi_line=False` is for case files without quoted line breaks.
    """
    cases, population = file_inputs(spark, layout, require_population, multi_line)
    return run_layers(spark, layout, cases, population, settings, domain, publish_failed, resume)


def run_layers(
    spark: SparkSession,
    layout: Layout,
    cases: Input,
    population: Input | None,
    settings: Settings | None = None,
    domain: CaseDomain | None = None,
    publish_failed: bool = False,
    resume: bool = True,
) -> RunResult:
    """The same from inputs of any kind; without `population`, no rates are built (cases only).

    Every layer is written once and read back by what follows, so that no stage recomputes an earlier one and a lost executor costs at
    most the layer in hand. With `resume`, layers that an earlier run has completed from the same inputs and settings are not made again, so a lost
    driver costs no more either.
    """
    settings, domain = settings or Settings(), domain or CaseDomain()
    run = Progress(spark, layout, repr((settings, domain)), resume)
    run.start("cases", cases.digest)
    run.start("denominators", population.digest if population else "none")
    raw = run.layer("raw_records", ("cases",), cases.read)
    tagged = run.layer("tagged", ("raw_records",), lambda: tag(canonical_cases(raw, domain), case_rules(settings, domain)))
    run.layer("quarantine", ("tagged",), lambda: quarantined_rows(tagged))
    identified = assign_case_id(clean_rows(tagged))
    clean = run.layer("clean", ("tagged",), lambda: keep_latest(identified))
    standardized = run.layer("standardized", ("clean",), lambda: standardized_cases(clean, domain))
    people = run.layer("population", ("standardized", "denominators"), lambda: carry_forward(
        clean_population(population.read(), settings, domain), standardized) if population else no_population(standardized))
    # Deduplication has made case ids unique, so counting ids needs no distinct.
    gold = run.layer("gold", ("standardized", "population"), lambda: gold_table(standardized, people, ids_unique=True))
    run.output("gold_csv", ("gold",), lambda: write_export(gold.orderBy(*gold.columns[:3]), layout.layer("gold_csv"), "csv"))
    run.output("star", ("standardized", "population"), lambda: build_star(standardized, people, domain, layout.layer("star"), ids_unique=True))
    star = stored_star(spark, domain, layout.layer("star"))
    layers = Layers(raw, tagged, identified, standardized, gold, star, people)
    report = run.layer("quality", ("star", "gold"), lambda: quality_report(layers, settings, domain, population is not None))
    run.output("quality_csv", ("quality",), lambda: write_quality(report, layout.layer("quality.csv"), layout.layer("quality_errors.csv")))
    failed = bool(has_failure(report).first()[0])
    counts = publish(star, report, layout.mart, source=layout.root) if publish_failed or not failed else {}
    return RunResult(counts, failed, tuple(run.made))


def main(arguments: list[str] | None = None) -> int:
    """Exit code 1 when a quality rule failed and `--fail-on-dq` is given. Without it, a run that failed is published with its report."""
    parser = argparse.ArgumentParser(description="Build and publish the case mart")
    parser.add_argument("--root", required=True, help="folder or URI that holds raw/ and receives processed/")
    parser.add_argument("--fail-on-dq", action="store_true")
    parser.add_argument("--allow-missing-population", action="store_true")
    parser.add_argument("--from-start", action="store_true", help="make all layers again, also those that an earlier run has completed")
    parser.add_argument("--one-line-records", action="store_true", help="no cell of the case files holds a line break")
    options = parser.parse_args(arguments)
    builder = SparkSession.builder.appName("casemart")
    for key, value in Settings.from_env().session_conf().items():
        builder = builder.config(key, value)
    result = run_batch(builder.getOrCreate(), Layout(options.root), Settings.from_env(),
                       require_population=not options.allow_missing_population, publish_failed=not options.fail_on_dq,
                       resume=not options.from_start, multi_line=not options.one_line_records)
    return 1 if result.failed and options.fail_on_dq else 0


if __name__ == "__main__":
    raise SystemExit(main())


__all__ = ["Input", "RunResult", "current_mart", "main", "run_batch", "run_layers"]
