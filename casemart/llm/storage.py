"""Intermediate results as Parquet in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; where it is unset, a local session gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="casemart-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


_lock = threading.Lock()
_writers: dict[int, tuple[int, str]] = {}


@contextmanager
def _shuffle_files_removed(spark: SparkSession):
    """The setting for as long as any thread of the session writes; the last one puts back what was there."""
    session = id(spark._jsparkSession)
    with _lock:
        count, before = _writers.get(session, (0, spark.conf.get(_CLEANUP, "false")))
        _writers[session] = count + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            count, before = _writers.pop(session)
            if count > 1:
                _writers[session] = count - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


class Scratch:
    """Tables that one operator call writes; each can be dropped as soon as nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, table: str, **options: str) -> DataFrame:
        """Write `df` and read it back: lineage ends here and the shuffle files of the job are removed with it. `options`: of the Parquet writer."""
        path = f"{self.root}/{table}"
        with _shuffle_files_removed(self.spark):
            df.write.mode("overwrite").options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        """Remove stored tables."""
        jvm = self.spark._jvm
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
