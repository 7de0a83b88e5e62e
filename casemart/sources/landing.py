"""Fingerprints of landed files and the rule that landed files never change."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemart.sources.catalog import latest_full

CHUNK_BYTES = 1 << 20


def file_sha256(path: str) -> str:
    """SHA-256 of a file, read in chunks. Schemes are those of the listing; the S3 connectors share one client."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)
    digest = hashlib.sha256()
    with store.open_input_stream(name, compression=None) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            digest.update(chunk)
    return digest.hexdigest()


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(sha256=batch["path"].map(file_sha256))


def fingerprints(spark: SparkSession, location: str) -> DataFrame:
    """`path, filename, format, size_bytes, sha256` per file; SHA-256 over the whole content.

    Each file is read in chunks by the task that lists it, so its size doesn't matter; contents never enter a row.
    """
    files = spark.read.format("binaryFile").load(location).select("path", F.col("length").alias("size_bytes"))
    hashed = files.mapInPandas(_hash_files, "path string, size_bytes long, sha256 string")
    name = F.element_at(F.split("path", "/"), -1)
    return hashed.withColumns({
        "filename": name, "format": F.lower(F.element_at(F.split(name, r"\."), -1)),
    })


def manifest(prints: DataFrame, counts: DataFrame, dataset: str, source: str, year: Column, key: Column) -> DataFrame:
    """One manifest row per landed file. `counts` gives `path, records`."""
    return prints.join(counts.select("path", "records"), "path", "left").select(
        F.lit(dataset).alias("dataset"), F.lit(source).alias("source"), year.alias("year_be"), "filename",
        key.alias("object_key"), "format", F.col("records").alias("record_count"), "size_bytes", "sha256",
        F.current_timestamp().alias("landed_at"),
    )


def landing_status(incoming: DataFrame, landed: DataFrame, key: str = "object_key") -> DataFrame:
    """`key, status`: new, unchanged, conflict (same key, other content) or kept (not offered again)."""
    ours = incoming.select(key, F.col("sha256").alias("_new"), F.lit(True).alias("_offered"))
    theirs = landed.select(key, F.col("sha256").alias("_old"), F.lit(True).alias("_landed"))
    status = (
        F.when(F.isnull("_landed"), "new").when(F.isnull("_offered"), "kept")
        .when(F.coalesce(F.col("_new") == F.col("_old"), F.lit(False)), "unchanged").otherwise("conflict")
    )
    return ours.join(theirs, key, "full").select(key, status.alias("status"))


def content_status(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """`year, status`: whether each offered file repeats the newest landed full file of its year.

    Both sides have `path, sha256`.
    """
    newest = latest_full(landed).join(landed.select("path", "sha256"), "path").select(
        "year", F.col("sha256").alias("_old")
    )
    offered = latest_full(incoming).join(incoming.select("path", "sha256"), "path").select("year", "sha256")
    same = F.coalesce(F.col("sha256") == F.col("_old"), F.lit(False))
    return offered.join(newest, "year", "left").select(
        "year", F.when(same, "unchanged").otherwise("new").alias("status")
    )
