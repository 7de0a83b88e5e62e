"""Audited publication: a mart becomes visible as a whole or not at all.

The audit is a log of numbered commit files. A file is created only where none exists, so publishers that run side by side get different numbers without
a lock, and the highest filled number is the current mart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casemart.operators.constraints import check_constraints
from casemart.operators.star import FACT_KEY, Star
from casemart.sinks.files import write_parquet
from casemart.sinks.small_files import create_exclusively
from casemart.sources.paths import found, list_files

#: Facts lie in a folder for each month, so that a filter on the calendar reads the folders of its months only.
STORED_BY_MONTH = ("fact_disease_cases",)
ENTRY_SCHEMA = "run_id string, loaded_at timestamp, source string, row_counts map<string,long>"
AUDIT_SCHEMA = f"load_id long, {ENTRY_SCHEMA}"


class PublishError(RuntimeError):
    """The new mart breaks its contract; the previous one stays published."""


def audit_path(root: str) -> str:
    return f"{root.rstrip('/')}/load_audit"


def run_path(root: str, run_id: str, table: str) -> str:
    return f"{root.rstrip('/')}/run={run_id}/{table}"


def commit_path(root: str, load_id: int) -> str:
    return f"{audit_path(root)}/{load_id:020d}.json"


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """One row for each load; commit files that were created and never filled are no loads."""
    path = audit_path(root)
    if not found(spark, path):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    entries = spark.read.schema(ENTRY_SCHEMA).option("pathGlobFilter", "*.json").json(path)
    load_id = F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).try_cast("long")
    return entries.select(load_id.alias("load_id"), *entries.columns).where("run_id IS NOT NULL")


def publish(star: Star, quality: DataFrame, root: str, source: str) -> dict[str, int]:
    """Write a new run, verify it, then append one commit to the audit; it is what makes the run current.

    Dimensions are written before facts. Each write counts its own rows; the stored files are counted
    again and checked against every constraint. A failure leaves the audit, and so the readers, alone.
    """
    spark = quality.sparkSession
    run_id = uuid.uuid4().hex
    tables = {**star.tables(), "data_quality": quality}
    written: dict[str, int] = {}
    stored: dict[str, DataFrame] = {}
    for name, table in tables.items():
        seen = Observation()
        path = run_path(root, run_id, name)
        by_month = name in STORED_BY_MONTH
        # months are cut where they are large, and places lie together within them
        ordered = table.hint("rebalance", "date_key").sortWithinPartitions("date_key", "district_key") if by_month else table
        write_parquet(ordered.observe(seen, F.count(F.lit(1)).alias("rows")), path, ["date_key"] if by_month else (), overwrite=False)
        written[name] = seen.get["rows"]
        stored[name] = spark.read.schema(table.schema).parquet(path)
    verify(stored, written)
    append_audit(spark, root, run_id, source, written)
    return written


def verify(stored: Mapping[str, DataFrame], written: Mapping[str, int]) -> None:
    """Raise unless the stored tables have the written row counts and meet every constraint."""
    for name, table in stored.items():
        rows = table.count()
        if rows != written[name]:
            raise PublishError(f"{name}: wrote {written[name]} rows, stored {rows}")
    broken = check_constraints(stored).where("status = 'FAIL'").collect()
    if broken:
        raise PublishError("; ".join(f"{b.table_name} {b.kind} {b.constraint_name}: {b.violations}" for b in broken))


def last_load(spark: SparkSession, root: str) -> int:
    """The highest number that any writer has taken, filled or not; 0 if none has."""
    if not found(spark, audit_path(root)):
        return 0
    files = list_files(spark, audit_path(root), "*.json")
    number = F.regexp_extract("path", r"(\d+)\.json$", 1).try_cast("long")
    return files.agg(F.max(number)).first()[0] or 0


def append_audit(spark: SparkSession, root: str, run_id: str, source: str, counts: Mapping[str, int]) -> int:
    """Take the next load id and make the run current. Of two writers that want one id, one gets it and the other takes the next."""
    loaded_at = datetime.now(timezone.utc).isoformat(timespec="milliseconds")
    entry = json.dumps({"run_id": run_id, "loaded_at": loaded_at, "source": source, "row_counts": dict(counts)}, ensure_ascii=False)
    number = 0
    while True:
        number = max(last_load(spark, root), number) + 1
        if create_exclusively(spark, commit_path(root, number), entry):
            return number


def current_mart(spark: SparkSession, root: str) -> tuple[Star, DataFrame]:
    """The newest audited run: its star and its quality report."""
    newest = read_audit(spark, root).agg(F.max_by("run_id", "load_id")).first()[0]
    if newest is None:
        raise FileNotFoundError(f"nothing has been published under {root}")
    names = [*Star.__dataclass_fields__, "data_quality"]
    tables = {name: spark.read.parquet(run_path(root, newest, name)) for name in names}
    fact = tables["fact_disease_cases"]
    tables["fact_disease_cases"] = fact.select(*FACT_KEY, *[name for name in fact.columns if name not in FACT_KEY])
    return Star.of(tables), tables["data_quality"]
