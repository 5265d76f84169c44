"""Which batch folders of a raw layer a reader sees, while merges replace many of them by one.

A merge writes its rows into a folder `batch=merged-<id>` per source and hour. Nobody sees it until a swap is published: a
small file below `_merged/year=/month=/day=`, created under its final name in one rename. It names the merged batch and the
batches it stands for. A reader takes the swaps of its days first and lists folders afterwards, so it sees a day either before
the swap or after it. A batch that came late is in no swap and stays visible beside the merged one. A batch that its stream
repeats after it was merged is in the swap, and stays hidden.

Swaps of a day are numbered. A merge publishes the number that follows those it has read, so of two merges at a time one fails.
The rename must refuse an existing name; HDFS and local file systems do, an object store needs a file system that does.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from paylake.schemas import DAY_PARTS

#: The last level of the raw layer: one folder per batch that wrote to an hour.
BATCH = "batch"
MERGED = "merged-"
_FOLDER = "_merged"
#: What a swap looks like once its hidden folders are gone.
_KEPT = ".kept"

#: A batch folder within a day: source, hour, batch.
Place = tuple[str, str, str]


@dataclass
class Swap:
    """One published swap of one day."""

    day: tuple[str, str, str]
    number: int
    published: str
    hidden: list[Place] = field(default_factory=list)
    at: datetime | None = None
    kept: bool = False


def folder_of(spark: SparkSession, root: str, day: tuple[str, str, str], place: Place) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    source, hour, batch = (escape(value) for value in place)
    year, month, date = day
    return f"{root}/source={source}/year={year}/month={month}/day={date}/hr={hour}/{BATCH}={batch}"


def file_system(spark: SparkSession, path: str):
    """The path for the file system, and the file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def read_swaps(spark: SparkSession, root: str, days: str = "year=*/month=*/day=*") -> list[Swap]:
    """The published swaps of some days, in order. One small file each, a few per day."""
    pattern, files = file_system(spark, f"{root}/{_FOLDER}/{days}/[0-9]*")
    found: dict[tuple, Swap] = {}
    for status in files.globStatus(pattern) or []:
        name = status.getPath().getName()
        parent = status.getPath().getParent().toString().split("/")[-3:]
        day = tuple(level.partition("=")[2] for level in parent)
        key, kept = (day, int(name.removesuffix(_KEPT))), name.endswith(_KEPT)
        if key in found and found[key].kept:
            continue
        stream = files.open(status.getPath())
        try:
            told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        at = datetime.fromtimestamp(status.getModificationTime() / 1000, UTC).replace(tzinfo=None)
        found[key] = Swap(day, key[1], told["published"], [tuple(place) for place in told["hidden"]], at, kept)
    return [found[key] for key in sorted(found)]


def _write(spark: SparkSession, root: str, swap: Swap, name: str) -> None:
    year, month, date = swap.day
    folder = f"{root}/{_FOLDER}/year={year}/month={month}/day={date}"
    draft, files = file_system(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    files.mkdirs(draft.getParent())
    stream = files.create(draft, False)
    stream.write(json.dumps({"published": swap.published, "hidden": swap.hidden}).encode())
    stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(draft, file_system(spark, f"{folder}/{name}")[0], options)


def publish(spark: SparkSession, root: str, swap: Swap) -> None:
    """Make a swap visible; fails if its number is taken."""
    _write(spark, root, swap, f"{swap.number:06d}")


def keep_hidden(spark: SparkSession, root: str, swap: Swap) -> None:
    """Shorten a swap whose hidden folders are gone.

    A stream may only repeat its newest batch, so of each stream the highest number stays hidden in its hours.
    """
    highest: dict[tuple[str, str, str], int] = {}
    for source, hour, batch in swap.hidden:
        numbered = re.fullmatch(r"(.+)-(\d+)", batch)
        if numbered and not batch.startswith(MERGED):
            key = (source, hour, numbered[1])
            highest[key] = max(int(numbered[2]), highest.get(key, 0))
    left = [(source, hour, f"{stream}-{number}") for (source, hour, stream), number in sorted(highest.items())]
    _write(spark, root, Swap(swap.day, swap.number, swap.published, left), f"{swap.number:06d}{_KEPT}")


def place_key() -> Column:
    return F.to_json(F.array(*DAY_PARTS, "source", "hr", BATCH))


def key_of(day: tuple[str, str, str], place: Place) -> str:
    return json.dumps([*day, *place], separators=(",", ":"), ensure_ascii=False)


def is_visible(swaps: Iterable[Swap]) -> Column:
    """On partition columns, so it costs one look per folder: published, and not replaced."""
    published = [F.concat_ws("/", *[F.lit(part) for part in (*s.day, s.published)]) for s in swaps]
    named = F.concat_ws("/", *DAY_PARTS, BATCH)
    batch = F.coalesce(F.col(BATCH), F.lit(""))
    seen = ~batch.startswith(MERGED)
    seen = seen | named.isin(published) if published else seen
    hidden = [key_of(s.day, place) for s in swaps for place in s.hidden]
    return seen & ~place_key().isin(hidden) if hidden else seen
