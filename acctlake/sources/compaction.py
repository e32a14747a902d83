"""Many small run folders of closed months become few large files, while readers and ingest go on.

Publishing is append-only, one folder a run: a month of quarter-hourly runs is some 2 900 folders for each system. :func:`compact` writes the
rows of such folders anew, in one job for all chosen months, checks that every run's rows are there and then publishes a new version of
the table's manifest (:mod:`acctlake.sources.manifest`). Nothing is changed in place: a reader that has listed the old folders
goes on with them, and a job that dies before the manifest is published leaves only a folder that no reader looks at.
:func:`vacuum` removes what has not counted for longer than any reader runs.

Rows keep the run they came from: merged files have it as ``origin_run`` and readers show it as ``run_id``. Only runs in the account of files
are merged, for those have ended; a run that comes late is read beside the merged rows and goes into the next compaction. A run must
not be repeated under its name once its month is compacted: it is in the manifest as replaced, and its new folder would not count.

Scale. Rows are moved once, with a rebalance by customer, system and month: a hot system is cut into files of the wanted size, or of what
one task can sort in memory if that is less, and small ones share a task. Checks count rows per run out of the files' footers.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.sources import dataset as D
from acctlake.sources import manifest as M

#: Size of a merged file, and by how much rows in a shuffle are larger than in such a file (measured on given tables: 2 to 4 times).
FILE_BYTES, LARGER = 128 << 20, 3
#: A task sorts its rows, which take some 25 times their bytes in a shuffle (measured on given tables: 18 to 24 times), so it gets
#: no more than this. Folders that are smaller still have one file; larger ones have several, of about a quarter of this size (measured).
TASK_BYTES = 64 << 20
#: How long folders are kept after they stopped to count: longer than any reader runs, in seconds.
RETENTION = 7 * 24 * 3600.0
#: Folders that are removed at the same time.
REMOVERS = 16


def task_bytes(file_bytes: int) -> int:
    """Bytes of a shuffle that one task sorts and writes."""
    return min(file_bytes * LARGER, TASK_BYTES)


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _folders(spark: SparkSession, root: str, table: str, year: str = "*", month: str = "*", run: str = "*") -> list[tuple[str, float]]:
    return M.matching(spark, f"{D.table_path(root, table)}/customer=*/path_system_id=*/year={year}/month={month}/run_id={run}")


def months_present(spark: SparkSession, root: str, table: str, before: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """Year and month of the table's folders, those before ``before`` if it is given."""
    found = set()
    for path, _ in M.matching(spark, f"{D.table_path(root, table)}/customer=*/path_system_id=*/year=*/month=*"):
        parts = re.search(r"/year=(\d+)/month=(\d+)$", path)
        if parts:
            found.add((int(parts[1]), int(parts[2])))
    return sorted(m for m in found if before is None or m < before)


def _counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("year", "month", F.coalesce(M.ORIGIN, "run_id").alias("run")).agg(F.count(F.lit(1)).alias("n"))


def compact(spark: SparkSession, root: str, table: str, months: Sequence[tuple[int, int]],
            file_bytes: int = FILE_BYTES) -> dict[tuple[int, int], int]:
    """Merge the ended runs of the given months; per month how many run folders were replaced.

    Months with fewer than two such runs are left as they are. Raises if rows differ afterwards, or if another compaction of the table has
    published meanwhile; readers see nothing of such an attempt.
    """
    seen = M.read(spark, root, table)
    ended = {r["run_id"] for r in D.read_files(spark, root).select("run_id").distinct().toLocalIterator()}
    chosen: dict[tuple[str, str], list[str]] = {}
    for year, month in dict.fromkeys(months):
        key = (f"{year:04d}", f"{month:02d}")
        merged = seen.of(*key)
        runs = {path.rsplit("run_id=", 1)[1] for path, _ in _folders(spark, root, table, *key)}
        runs -= set(merged.replaces) if merged else set()
        runs = sorted(r for r in runs if r in ended or (merged and r == merged.run_id))
        if len(runs) > 1:
            chosen[key] = runs
    if not chosen:
        return {}

    name = f"{M.MERGED}{uuid.uuid4().hex}"
    here = F.lit(False)
    for (year, month), runs in chosen.items():
        here = here | ((F.col("year") == year) & (F.col("month") == month) & F.col("run_id").isin(runs))
    rows = D.read_folders(spark, root, table).where(here)
    moved = rows.withColumns({M.ORIGIN: F.coalesce(M.ORIGIN, "run_id"), "run_id": F.lit(name)})
    # By folder, as the writer wants it, then by time.
    order = [c for c in ("table_name", *D.PARTITIONS, "smf_timestamp") if c in moved.columns]
    moved = D.clustered(moved, "customer", "path_system_id", "year", "month").sortWithinPartitions(*order)
    sizes = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes(file_bytes)),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    published = False
    try:
        with _settings(spark, sizes):
            D.write_table(moved, D.folder_of(root, table), by_table="table_name" in rows.columns)
        after = D.read_folders(spark, root, table).where(F.col("run_id") == name)
        keys = ["year", "month", "run"]
        wrong = _counts(rows).withColumnRenamed("n", "had").join(_counts(after), keys, "full").where(
            ~F.col("had").eqNullSafe(F.col("n"))
        )
        if not wrong.isEmpty():
            raise RuntimeError(f"{table}: merged rows are not those of the runs; nothing is published")
        since = M.now()
        entries = []
        for (year, month), runs in chosen.items():
            before = seen.of(year, month)
            gone = dict.fromkeys([*(before.replaces if before else ()), *runs])
            entries.append(M.Month(year, month, name, tuple(gone), since))
        M.commit(spark, root, table, seen, seen.with_months(entries))
        published = True
    finally:
        if not published:
            remove(spark, [path for year, month in chosen for path, _ in _folders(spark, root, table, year, month, name)])
    return {(int(year), int(month)): len(runs) for (year, month), runs in chosen.items()}


def vacuum(spark: SparkSession, root: str, table: str, retention: float = RETENTION) -> int:
    """Remove the folders that have not counted for ``retention`` seconds: replaced runs, and merged rows that were never published.

    Returns how many folders went. Safe to repeat after it died half-way: what is removed last is the list of names.
    """
    seen = M.read(spark, root, table)
    limit = M.now() - retention
    old = [m for m in seen.months if m.replaces and m.since <= limit]
    gone = []
    for m in old:
        names = set(m.replaces)
        gone += [p for p, _ in _folders(spark, root, table, m.year, m.month) if p.rsplit("run_id=", 1)[1] in names]
    counted = {m.run_id for m in seen.months}
    listed = {n for m in seen.months for n in m.replaces}
    gone += [
        path for path, changed in _folders(spark, root, table, run=f"{M.MERGED}*")
        if path.rsplit("run_id=", 1)[1] not in counted | listed and changed <= limit
    ]
    remove(spark, gone)
    if old:
        M.commit(spark, root, table, seen, seen.with_months([replace(m, replaces=()) for m in old]))
    return len(gone)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders, several at a time."""

    def one(path: str) -> None:
        files, where = M.file_system(spark, path)
        files.delete(where, True)

    with ThreadPoolExecutor(REMOVERS) as pool:
        list(pool.map(one, paths))
