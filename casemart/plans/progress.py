"""Which layers of a run are complete, so that a run that lost its driver goes on after the last one.

Every layer has a key: a digest of its name, of the settings and of the keys of what it is made from; the first ones are made from fingerprints of the input files. A
manifest with key, row count and columns is written after the layer, and removed before the layer is written again. A layer
whose manifest has the wanted key is read instead of made, so a changed input, setting or version invalidates all that follows from it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casemart.config import Layout
from casemart.sinks.files import write_parquet
from casemart.sinks.small_files import read_text, remove, write_text

#: To be raised with every change that makes layers of the same input different.
LAYER_VERSION = 1


def fingerprint(files: DataFrame) -> str:
    """Digest of a listing (path, length, modification time): a few files, one for each year."""
    rows = sorted((row["path"], row["length"], str(row["modificationTime"])) for row in files.collect())
    return hashlib.sha256(json.dumps(rows).encode()).hexdigest()


@dataclass
class Progress:
    """The layers of one run. `made` lists them in order with their rows (None where nothing is counted) and whether they were there already."""

    spark: SparkSession
    layout: Layout
    basis: str
    resume: bool = True
    keys: dict[str, str] = field(default_factory=dict)
    made: list[tuple[str, int | None, bool]] = field(default_factory=list)

    def start(self, name: str, digest: str) -> None:
        """An input."""
        self.keys[name] = digest

    def manifest(self, name: str) -> str:
        return self.layout.layer(f"_manifests/{name}.json")

    def step(self, name: str, sources: tuple[str, ...], make: Callable[[], dict], again: Callable[[dict], object] = lambda entry: None):
        """`again(manifest)` if the step is complete, else `make()`, which returns what its manifest is to hold."""
        parts = [str(LAYER_VERSION), name, self.basis, *(self.keys[source] for source in sources)]
        key = self.keys[name] = hashlib.sha256("\n".join(parts).encode()).hexdigest()
        text = read_text(self.spark, self.manifest(name)) if self.resume else None
        entry = json.loads(text) if text else {}
        if entry.get("key") == key:
            self.made.append((name, entry.get("rows"), True))
            return again(entry)
        remove(self.spark, self.manifest(name))
        entry = {**make(), "key": key}
        write_text(self.spark, self.manifest(name), json.dumps(entry))
        self.made.append((name, entry.get("rows"), False))
        return again(entry)

    def layer(self, name: str, sources: tuple[str, ...], make: Callable[[], DataFrame]) -> DataFrame:
        """A stored table: written and counted in one job, then read back with its columns."""
        path = self.layout.layer(name)

        def write() -> dict:
            table, seen = make(), Observation()
            write_parquet(table.observe(seen, F.count(F.lit(1)).alias("rows")), path)
            return {"rows": seen.get["rows"], "schema": table.schema.json()}

        return self.step(name, sources, write, lambda entry: self.spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(path))

    def output(self, name: str, sources: tuple[str, ...], write: Callable[[], None]) -> None:
        """Files that nothing of the run reads."""
        def run() -> dict:
            write()
            return {}

        self.step(name, sources, run)
