"""Settings and storage layout. The Spark session is always passed in, never created here."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Validation limits and session values, with environment overrides."""

    timezone: str = "Asia/Bangkok"
    shuffle_partitions: int | None = None
    max_missing_population_rate: float = 0.05
    minimum_year_be: int = 2400
    maximum_year_be: int = 2700
    maximum_age: int = 120
    min_retention_rate: float = 0.5

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> "Settings":
        env = os.environ if env is None else env
        partitions = env.get("SPARK_SHUFFLE_PARTITIONS")
        return cls(
            timezone=env.get("SPARK_TIMEZONE", cls.timezone),
            shuffle_partitions=int(partitions) if partitions else None,
            max_missing_population_rate=float(
                env.get("DQ_MAX_MISSING_POPULATION_RATE", cls.max_missing_population_rate)
            ),
        )

    def session_conf(self) -> dict[str, str]:
        """Options for `spark-submit --conf`; left to AQE where the user sets nothing."""
        conf = {
            "spark.sql.session.timeZone": self.timezone,
            "spark.sql.parquet.compression.codec": "snappy",
            "spark.sql.adaptive.enabled": "true",
            "spark.sql.adaptive.skewJoin.enabled": "true",
            # The JVM never compiles a larger method; Spark then generates several small ones instead.
            "spark.sql.codegen.hugeMethodLimit": "8000",
        }
        if self.shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(self.shuffle_partitions)
        return conf


def is_remote(location: str) -> bool:
    return "://" in location and not location.startswith("file:")


@dataclass(frozen=True)
class Layout:
    """Where every layer lives below one root, on any file system Spark can reach."""

    root: str

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw_cases_glob(self) -> str:
        return self.at("raw", "disease", "year=*", "disease_cases_*")

    @property
    def raw_population_glob(self) -> str:
        return self.at("raw", "population", "year=*", "population_summary_*.csv")

    def layer(self, name: str) -> str:
        return self.at("processed", name)

    @property
    def mart(self) -> str:
        return self.at("processed", "warehouse")
