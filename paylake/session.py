"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import SparkSession

SETTINGS = {
    # Offsets in received_at are resolved to UTC; nothing may depend on the host zone.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the message.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Merge sessions of one key map-side, so a hot key reaches the shuffle pre-aggregated.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Partition values are text wherever they are read, so `02` does not become 2.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recursive queries end when a step adds no rows, not at a fixed size or depth.
    "spark.sql.cteRecursionRowLimit": "-1",
    "spark.sql.cteRecursionLevelLimit": "-1",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the time of a block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for written intermediates, below the folder the cluster shares."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


S, T = TypeVar("S"), TypeVar("T")


def for_each(items: Sequence[S], job: Callable[[S], T], at_once: int | None = None) -> list[T]:
    """Run a job per item side by side, at most `at_once` of them, so a small one does not leave the executors idle."""
    with ThreadPoolExecutor(max_workers=max(1, min(len(items), at_once or len(items)))) as pool:
        return list(pool.map(job, items))
