"""Directory and single-file writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.operators.quality import failing_rules
from casemart.operators.ranking import positioned

# Text is written as it is: blanks kept, quotes doubled.
CSV_OPTIONS = {
    "header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), overwrite: bool = True) -> None:
    """Snappy Parquet directory; refuses an existing target unless `overwrite`."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_export(df: DataFrame, path: str, fmt: str, overwrite: bool = True, single_file: bool = False) -> None:
    """CSV, Parquet or lines of text: a directory at `path` with as many files as `df` has partitions or, if the caller asks for it, the one file `path`.

    One file means one writing task, so it is for results whose size is bounded, such as reports and small dimensions.
    The file is written beside its target and renamed, on any file system that Spark reaches.
    """
    if fmt not in ("csv", "parquet", "text"):
        raise ValueError(f"unsupported export format {fmt}")
    mode = "overwrite" if overwrite else "errorifexists"
    options = {"csv": CSV_OPTIONS, "parquet": {"compression": "snappy"}, "text": {}}[fmt]
    if not single_file:
        df.write.mode(mode).options(**options).format(fmt).save(path)
        return
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    target, staging = path_of(path), path_of(f"{path}.staging")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(target) and not overwrite:
        raise FileExistsError(f"{path} exists; pass overwrite=True to replace it")
    df.coalesce(1).write.mode("overwrite").options(**options).format(fmt).save(staging.toString())
    part = store.globStatus(path_of(staging, "part-*"))[0].getPath()
    store.delete(target, True)
    store.rename(part, target)
    store.delete(staging, True)


def write_quality(report: DataFrame, path: str, errors_path: str) -> None:
    """The report, and next to it only the failing rules."""
    write_export(report, path, "csv", single_file=True)
    write_export(failing_rules(report), errors_path, "csv", single_file=True)


def write_tables(
    tables: Mapping[str, DataFrame], parquet_root: str, csv_root: str | None = None, single_file: bool = False
) -> None:
    """Every table as Parquet and, for consumers of text, as CSV read back from that Parquet."""
    for name, table in tables.items():
        path = f"{parquet_root.rstrip('/')}/{name}"
        write_parquet(table, path)
        if csv_root:
            stored = table.sparkSession.read.schema(table.schema).parquet(path)
            write_export(stored, f"{csv_root.rstrip('/')}/{name}.csv", "csv", single_file=single_file)


# The order in which a consumer reads each table.
EXPORT_ORDER: dict[str, tuple[str, ...]] = {
    "fact_disease_cases": ("date_key", "district_key", "disease_key", "age_group_key", "sex"),
    "fact_population": ("year_be", "district_key"),
    "dim_date": ("date_key",),
    "dim_district": ("district_key",),
    "dim_disease": ("disease_key",),
    "dim_age_group": ("age_group_key",),
    "dim_sex": ("sex",),
}


def positioned_export(name: str, table: DataFrame, path: str) -> DataFrame:
    """A table with the position of every row in its export order (runs a job that writes `path`)."""
    return positioned(table, EXPORT_ORDER[name], path)


def ordered_export(name: str, table: DataFrame) -> DataFrame:
    """A table in its export order; dates stay dates."""
    return table.orderBy(*EXPORT_ORDER[name])


def select_by_header(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """The columns a header names, in its order; names that could not be plain identifiers are refused."""
    names = [name.replace("\ufeff", "").strip() for name in header]
    if not names:
        raise ValueError("an empty header names no columns")
    for name in names:
        if not name.replace("_", "").isalnum():
            raise ValueError(f"unsafe column name {name!r}")
    return df.select(*[F.col(f"`{name}`") for name in names])
