"""Reporting tables kept up to date by month: only months that new runs have touched are built again.

The dataset's account of files says which runs have ended since the last refresh; the folders of their rows name the months, late
rows included. These months of the fact, the daily aggregate and the report are built from all their rows, once per input file, and
take the place of the month's last build in one step: a new version of ``<target>/_state`` that names a build for every month. The other months
stay where they are. New job names are added to the dimension; a changed mapping touches every month.

``<target>/data/<table>/year=…/month=…/build=…``; the dimension, the mapping and the seen runs are whole tables per build. Nothing is overwritten,
so a reader goes on with the version it has taken, and a refresh that dies leaves the last version in use. :func:`vacuum_marts` removes
builds that are not in use any more.

Scale. A refresh reads the folders of the touched months and the names of the dimension, whatever the length of the history.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.functions.text import date_parts
from acctlake.operators.checks import assert_checks
from acctlake.operators.mapping import dim_application
from acctlake.plans import marts
from acctlake.sources import dataset as D
from acctlake.sources import manifest as M
from acctlake.sources.compaction import RETENTION, remove
from acctlake.streaming.incremental import latest_copies

STATE = "_state"
BY_MONTH = ("fct_job_consumption", "agg_consumption_daily", "rpt_jobs_by_date")
WHOLE = ("dim_application", "map_job_application")
#: How Spark names the folder of a missing value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

MonthKey = tuple[str | None, str | None]


@dataclass(frozen=True)
class State:
    """One version of the marts: where each month and each whole table lives, and which mapping they were built with."""

    version: int
    months: dict[MonthKey, str]
    build: str | None
    patterns: str | None


def read_state(spark: SparkSession, target: str) -> State:
    version, stored = M.newest(spark, f"{target}/{STATE}")
    if not version:
        return State(0, {}, None, None)
    return State(version, {(y, m): b for y, m, b in stored["months"]}, stored["build"], stored["patterns"])


def _digest(patterns: DataFrame) -> str:
    """Stands for the mapping whatever the order of its rows."""
    row = F.xxhash64("job_pattern", "application", "app_group").cast("decimal(20,0)")
    return str(patterns.agg(F.count("*").alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("h")).first().asDict())


def _in_months(months: list[MonthKey]) -> Column:
    """A condition on the folders only."""
    chosen = F.lit(False)
    for year, month in months:
        chosen = chosen | (F.col("year").eqNullSafe(F.lit(year)) & F.col("month").eqNullSafe(F.lit(month)))
    return chosen


def touched_months(spark: SparkSession, root: str, runs: DataFrame) -> list[MonthKey]:
    """Months that hold rows of the given runs, merged rows too. A row per month reaches the driver."""
    rows = D.read_folders(spark, root, "smf30").select("year", "month", F.coalesce(M.ORIGIN, "run_id").alias("run_id"))
    found = rows.join(runs.select("run_id").distinct(), "run_id", "left_semi").select("year", "month").distinct()
    return sorted(((r["year"], r["month"]) for r in found.collect()), key=str)


def refresh_marts(spark: SparkSession, root: str, patterns: DataFrame, target: str, check: bool = True) -> list[MonthKey]:
    """Bring the marts at ``target`` up to the dataset at ``root``; returns the months that were built.

    A failed check leaves the last version in use; a refresh that is overtaken by another raises :class:`~acctlake.sources.manifest.Conflict`.
    """
    state = read_state(spark, target)
    account = D.read_files(spark, root)
    runs = account.select("run_id").distinct()
    if state.build:
        runs = runs.join(_whole(spark, target, "runs", state.build), "run_id", "left_anti")
    digest = _digest(patterns)
    months = touched_months(spark, root, runs)
    if state.build and digest != state.patterns:
        months = sorted({*months, *state.months}, key=str)
    if state.build and not months and runs.isEmpty():
        return []

    build = f"{uuid.uuid4().hex}"
    rows = latest_copies(D.read_table(spark, root, "smf30").where(_in_months(months)), account)
    staged = marts.stg_smf30(rows)

    def whole(name: str, df: DataFrame) -> DataFrame:
        path = f"{target}/data/{name}/build={build}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def by_month(name: str, df: DataFrame, *order: Column) -> DataFrame:
        parts = date_parts(F.col("smf_date"))
        placed = df.withColumns({"year": parts["year"], "month": parts["month"], "build": F.lit(build)})
        # A month's rows in few files; adaptive execution splits months that are large.
        placed = placed.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "build", *order)
        placed.write.partitionBy("year", "month", "build").mode("append").parquet(f"{target}/data/{name}")
        return _months(spark, target, name, dict.fromkeys(months, build), placed.drop("build"))

    published = False
    try:
        names = staged.select("customer", "job_name").distinct()
        if state.build and digest == state.patterns:
            old = _whole(spark, target, "dim_application", state.build)
            new = dim_application(names.join(old, ["customer", "job_name"], "left_anti"), patterns)
            dim = whole("dim_application", old.unionByName(new.select(*old.columns)))
        else:
            dim = whole("dim_application", dim_application(names, patterns))
        whole("map_job_application", patterns)
        whole("runs", account.select("run_id").distinct())
        fct = by_month("fct_job_consumption", marts.fct_job_consumption(staged, dim))
        daily = by_month("agg_consumption_daily", marts.agg_consumption_daily(fct))
        by_month("rpt_jobs_by_date", marts.rpt_jobs_by_date(fct), *marts.jobs_by_date_order())
        if check:
            assert_checks({
                "stg_smf30": staged, "map_job_application": patterns, "dim_application": dim,
                "fct_job_consumption": fct, "agg_consumption_daily": daily,
            })
        placed = {**state.months, **dict.fromkeys(months, build)}
        content = {"months": [[y, m, b] for (y, m), b in placed.items()], "build": build, "patterns": digest}
        M.publish(spark, f"{target}/{STATE}", state.version, content)
        published = True
    finally:
        if not published:
            remove(spark, [p for p, _ in _builds(spark, target) if p.endswith(f"/build={build}")])
    return months


def _whole(spark: SparkSession, target: str, name: str, build: str) -> DataFrame:
    return spark.read.parquet(f"{target}/data/{name}/build={build}")


def _months(spark: SparkSession, target: str, name: str, builds: dict[MonthKey, str], like: DataFrame | None = None) -> DataFrame:
    """The given builds of the given months; only their folders are listed."""
    base = f"{target}/data/{name}"
    paths = [
        f"{base}/year={year or NO_VALUE}/month={month or NO_VALUE}/build={build}" for (year, month), build in builds.items()
    ]
    paths = [p for p in paths if M.matching(spark, p)]
    if not paths:
        if like is None:
            raise ValueError(f"{target} has no months of {name}")
        rows = spark.createDataFrame([], like.schema)
    else:
        rows = spark.read.option("basePath", base).parquet(*paths).drop("build")
    return rows.withColumns({c: F.col(c).cast("int") for c in ("year", "month")})


def read_refreshed(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The stored models in their newest version, as :func:`acctlake.plans.marts.read_marts` gives them."""
    state = read_state(spark, target)
    if state.build is None:
        raise ValueError(f"no marts have been built at {target}")
    whole = {name: _whole(spark, target, name, state.build) for name in WHOLE}
    return {**whole, **{name: _months(spark, target, name, state.months) for name in BY_MONTH}}


def _builds(spark: SparkSession, target: str) -> list[tuple[str, float]]:
    return [
        *(x for name in BY_MONTH for x in M.matching(spark, f"{target}/data/{name}/year=*/month=*/build=*")),
        *(x for name in (*WHOLE, "runs") for x in M.matching(spark, f"{target}/data/{name}/build=*")),
    ]


def vacuum_marts(spark: SparkSession, target: str, retention: float = RETENTION) -> int:
    """Remove builds that the newest version does not name and that are older than ``retention`` seconds."""
    state, limit = read_state(spark, target), M.now() - retention
    used = {(y or NO_VALUE, m or NO_VALUE, b) for (y, m), b in state.months.items()}
    gone = []
    for path, changed in _builds(spark, target):
        month = re.search(r"/year=([^/]+)/month=([^/]+)/build=([^/]+)$", path)
        current = month.groups() in used if month else path.endswith(f"/build={state.build}")
        if not current and changed <= limit:
            gone.append(path)
    remove(spark, gone)
    return len(gone)
