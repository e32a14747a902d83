"""Reports over the marts, and their CSV export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from acctlake.functions.numbers import round_to, rounded_sum
from acctlake.plans.marts import job_rows, job_totals, jobs_by_date_order
from acctlake.session import scratch_dir


def jobs_by_date(marts: dict[str, DataFrame]) -> DataFrame:
    return marts["rpt_jobs_by_date"].select(
        "smf_date", "customer", "system_id", "application", F.col("job_label").alias("job_name"),
        "program_name", "step_runs", "cpu_sec", "ziip_sec", "elapsed_sec", "excp",
    ).orderBy(*jobs_by_date_order())


def consumption_daily(marts: dict[str, DataFrame]) -> DataFrame:
    return marts["agg_consumption_daily"].select(
        "smf_date", "customer", "application", "app_group", "system_id", "job_name", "step_runs",
        "cpu_sec", "ziip_sec", "elapsed_sec", "excp",
    ).orderBy(F.asc_nulls_last("smf_date"), F.desc_nulls_last("cpu_sec"))


def top_consumers(marts: dict[str, DataFrame], k: int = 100) -> DataFrame:
    keys = ("customer", "application", "job_name", "program_name")
    rows, dim = job_rows(marts)
    totals = job_totals(rows, keys, dim, {"total_cpu_sec": "cpu_sec", "total_excp": "excp_count"}, "runs")
    return (
        totals.select(
            *keys, "runs", round_to(F.col("total_cpu_sec"), 2).alias("total_cpu_sec"), "total_excp"
        )
        .orderBy(F.desc_nulls_last("total_cpu_sec"), *[F.asc_nulls_last(c) for c in keys])
        .limit(k)
    )


def consumption_by_application(marts: dict[str, DataFrame]) -> DataFrame:
    """The daily aggregate added up once more; the fact is not touched."""
    return marts["agg_consumption_daily"].groupBy("customer", "application", "app_group").agg(
        rounded_sum("cpu_sec", 2).alias("cpu_sec"),
        rounded_sum("ziip_sec", 2).alias("ziip_sec"),
        F.sum("step_runs").alias("step_runs"),
    ).orderBy(F.desc_nulls_last("cpu_sec"))


REPORTS = {
    "jobs_by_date": jobs_by_date,
    "consumption_daily": consumption_daily,
    "top_consumers": top_consumers,
    "consumption_by_application": consumption_by_application,
}


def _known(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}; there are {', '.join(df.columns)}")


def metric_by_dimension(table: DataFrame, dimension: str = "application",
                        metric: str = "cpu_sec") -> DataFrame:
    """Positive totals of a metric per value of a dimension, with their share of the whole."""
    _known(table, dimension, metric)
    totals = (
        table.where(F.col(metric).isNotNull())
        .groupBy(F.col(dimension).cast("string").alias("k"))
        .agg(F.sum(metric).alias("v"))
        .where("v > 0")
    )
    # One row per value, written once: the sum of all and the shares read this, not the whole table twice.
    spark, path = table.sparkSession, scratch_dir(table.sparkSession, "totals")
    totals.write.parquet(path)
    totals = spark.read.schema(totals.schema).parquet(path)
    whole = totals.agg(F.sum("v")).scalar()
    return totals.select("k", "v", (F.col("v") / whole).alias("share")).orderBy(
        F.desc_nulls_last("v"), F.asc_nulls_last("k")
    )


DRILL_PATH = ("customer", "application", "job_name", "step_name")


def drill(rows: DataFrame, levels: Iterable[str] = DRILL_PATH, customer: str | None = None,
          system_id: str | None = None, first: dt.date | None = None,
          last: dt.date | None = None, dim: DataFrame | None = None) -> DataFrame:
    """Consumption along the path customer, application, job, step, down to any depth.

    ``rows`` is the fact, or staged rows with the dimension given beside them.
    """
    levels = list(levels)
    known = rows if dim is None else rows.withColumns({"application": F.lit(""), "app_group": F.lit("")})
    _known(known, *levels)
    conditions: list[Column] = []
    if customer is not None:
        conditions.append(F.col("customer") == customer)
    if system_id is not None:
        conditions.append(F.col("system_id") == system_id)
    if first is not None:
        conditions.append(F.col("smf_date") >= F.lit(first))
    if last is not None:
        conditions.append(F.col("smf_date") <= F.lit(last))
    for condition in conditions:
        rows = rows.where(condition)
    totals = job_totals(
        rows, tuple(levels), dim,
        {"cpu_sec": "cpu_sec", "ziip_sec": "ziip_sec", "elapsed_sec": "elapsed_sec", "excp": "excp_count"}, "step_runs",
    )
    return totals.select(
        *levels, "step_runs",
        *[round_to(F.col(c), 2).alias(c) for c in ("cpu_sec", "ziip_sec", "elapsed_sec")], "excp",
    ).orderBy(F.desc_nulls_last("cpu_sec"), *[F.asc_nulls_last(c) for c in levels])


def export_csv(marts: dict[str, DataFrame], out: str, only: Iterable[str] | None = None,
               day: dt.date | None = None, single_file: bool = False) -> dict[str, int]:
    """Write the reports as ``<out>/<name>-<YYYYMMDD>`` with a header; returns rows per report.

    Sorted reports are written by many tasks: part files in name order are the report in order.
    ``single_file`` is for reports a spreadsheet can open; it puts the report through one task.
    """
    wanted = list(REPORTS) if only is None else [n for n in REPORTS if n in set(only)]
    if not wanted:
        raise ValueError("no report has one of the given names")
    stamp = (day or dt.date.today()).strftime("%Y%m%d")
    written = {}
    for name in wanted:
        rows = Observation(name)
        report = REPORTS[name](marts).observe(rows, F.count(F.lit(1)).alias("rows"))
        if single_file:
            report = report.coalesce(1)
        report.write.mode("overwrite").option("header", True).csv(f"{out}/{name}-{stamp}")
        written[name] = rows.get["rows"]
    return written
