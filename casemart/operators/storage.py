"""Cutting lineage with written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; where it is unset, a local session gets one of its own.

    A cluster has to name one, since a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="casemart-"))
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, below one folder per application so that it can be removed as a whole."""
    return f"{shared_folder(spark)}/casemart/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write `df` once as Parquet at `path` and read it back (runs a job).

    What follows starts from stored columns with real file sizes, so that Spark can choose joins by
    size, and a lost executor costs a re-read instead of a re-computation.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_side_by_side(folder: str, **tables: Callable[[], DataFrame]) -> list[DataFrame]:
    """`materialize` for tables that don't depend on each other, as concurrent jobs; each table is given as a function."""
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(lambda name: materialize(tables[name](), f"{folder}/{name}"), tables))
