"""A lake built from the given tables, for queries that read stored layers.

Layers are written once per session and table folder, below the shared scratch folder.
"""

from __future__ import annotations

from datetime import date
from functools import lru_cache

from pyspark.sql import SparkSession

from paylake import fixtures
from paylake.plans.jobs import compact_days, ingest_batch, process_days
from paylake.session import scratch_folder

SOURCES = ["faker", "stripe", "revolut"]
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 2)
SMALL_FILES = 64 * 1024


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._paths: dict[str, str] = {}

    def _layer(self, name: str, build) -> str:
        if name not in self._paths:
            path = scratch_folder(self.spark, name)
            build(path)
            self._paths[name] = path
        return self._paths[name]

    @property
    def raw(self) -> str:
        return self._layer(
            "raw", lambda path: ingest_batch(fixtures.all_env(self.spark, self.sf_dir, folded=True), path)
        )

    @property
    def processed(self) -> str:
        raw = self.raw
        return self._layer("processed", lambda path: process_days(self.spark, raw, path, FIRST, LAST, SOURCES))

    @property
    def analytics(self) -> str:
        processed = self.processed
        return self._layer(
            "analytics", lambda path: compact_days(self.spark, processed, path, FIRST, LAST, SOURCES, SMALL_FILES)
        )


@lru_cache(maxsize=4)
def _lake_of(application: str, spark: SparkSession, sf_dir: str) -> Lake:
    return Lake(spark, sf_dir)


def lake_of(spark: SparkSession, sf_dir: str) -> Lake:
    return _lake_of(spark.sparkContext.applicationId, spark, sf_dir)
