"""Which folders of a table count: the manifest that compaction writes and readers follow.

``<root>/_manifest/<table>/<version>.json`` lists, per compacted month, the folder with the merged rows and the run folders that it
replaces. Versions only grow and a version is created once; a reader takes the newest one that is whole and so sees either all of a
compaction or nothing of it. Without a manifest every run folder counts. Merged folders that no manifest names never count.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, replace
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FOLDER = "_manifest"
#: Run folders with such names hold merged rows.
MERGED = "compact-"
#: The run that a merged row came from.
ORIGIN = "origin_run"


class Conflict(RuntimeError):
    """Another compaction has published a version meanwhile."""


@dataclass(frozen=True)
class Month:
    """A compacted month: the folder that counts, the run folders that do not any more, and since when (epoch seconds)."""

    year: str
    month: str
    run_id: str
    replaces: tuple[str, ...]
    since: float


@dataclass(frozen=True)
class Manifest:
    """The compacted months of a table; version 0 stands for no manifest."""

    version: int = 0
    months: tuple[Month, ...] = ()

    def of(self, year: str, month: str) -> Month | None:
        return next((m for m in self.months if (m.year, m.month) == (year, month)), None)

    def with_months(self, new: list[Month]) -> Manifest:
        named = {(m.year, m.month) for m in new}
        return replace(self, months=(*(m for m in self.months if (m.year, m.month) not in named), *new))

    def visible(self) -> Column:
        """Whether a folder counts; a condition on directory columns only, so the others are not read."""
        run = F.col("run_id")
        shown = ~run.startswith(MERGED)
        if self.months:
            shown = shown | run.isin(sorted({m.run_id for m in self.months}))
        for m in self.months:
            if m.replaces:
                gone = (F.col("year") == m.year) & (F.col("month") == m.month) & run.isin(list(m.replaces))
                # A row without a date is in no month.
                shown = shown & ~F.coalesce(gone, F.lit(False))
        return shown


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path and the path: what Spark reads can be listed and written as well."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Folders and files of a pattern, and when they were last changed (epoch seconds)."""
    files, where = file_system(spark, pattern)
    return [(s.getPath().toString(), s.getModificationTime() / 1000) for s in files.globStatus(where) or []]


def _versions(spark: SparkSession, folder: str) -> list[int]:
    names = [path.rsplit("/", 1)[1] for path, _ in matching(spark, f"{folder}/*.json")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def newest(spark: SparkSession, folder: str) -> tuple[int, Any]:
    """The newest whole version in a folder of versions and what it holds; version 0 and None before the first."""
    io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    for version in reversed(_versions(spark, folder)):
        files, where = file_system(spark, f"{folder}/{version:010d}.json")
        stream = files.open(where)
        try:
            return version, json.loads(io.toString(stream, "UTF-8"))
        except ValueError:  # its writer has died, or is still at it
            continue
        finally:
            stream.close()
    return 0, None


def publish(spark: SparkSession, folder: str, seen: int, content: Any) -> int:
    """Write ``content`` as the version after all that exist, if none that is whole has come after ``seen``.

    The file is created, never overwritten. Stores whose ``create`` cannot refuse need one writer at a time.
    """
    if newest(spark, folder)[0] != seen:
        raise Conflict(f"{folder}: there is a version after {seen}")
    version = max([seen, *_versions(spark, folder)]) + 1
    files, where = file_system(spark, f"{folder}/{version:010d}.json")
    try:
        stream = files.create(where, False)
    except Exception as problem:
        if "already exists" not in str(problem):
            raise
        raise Conflict(f"{folder}: version {version} is there") from problem
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    return version


def read(spark: SparkSession, root: str, table: str) -> Manifest:
    """The newest whole manifest."""
    version, stored = newest(spark, f"{root}/{FOLDER}/{table}")
    return Manifest(version, tuple(Month(**{**m, "replaces": tuple(m["replaces"])}) for m in stored or []))


def commit(spark: SparkSession, root: str, table: str, seen: Manifest, changed: Manifest) -> Manifest:
    """Publish ``changed`` if no other compaction has published after ``seen``."""
    version = publish(spark, f"{root}/{FOLDER}/{table}", seen.version, [asdict(m) for m in changed.months])
    return replace(changed, version=version)


def now() -> float:
    return time.time()
