"""Ready-made consumption queries over type-30 rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlake.functions.numbers import round_to, rounded_sum
from acctlake.functions.text import job_label, program_label


def jobs_per_date(smf30: DataFrame) -> DataFrame:
    """All jobs that ran on each date, zero consumption included."""
    keys = ("smf_date", "system_id", "job_name", "program_name")
    shown = smf30.select(
        "smf_date", "system_id", job_label().alias("job_name"),
        program_label().alias("program_name"), "cpu_sec", "ziip_sec", "elapsed_sec", "excp_count",
    )
    return shown.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("step_runs"),
        *[rounded_sum(c, 2).alias(c) for c in ("cpu_sec", "ziip_sec", "elapsed_sec")],
        F.sum("excp_count").alias("excp"),
    ).orderBy(
        F.asc_nulls_last("smf_date"), F.asc_nulls_last("system_id"), F.desc_nulls_last("cpu_sec"),
        F.asc_nulls_last("job_name"),
    )


def daily_consumption(smf30: DataFrame) -> DataFrame:
    """Consumption by date, system and job."""
    return smf30.groupBy("smf_date", "system_id", "job_name").agg(
        F.count(F.lit(1)).alias("step_runs"),
        *[rounded_sum(c, 2).alias(c) for c in ("cpu_sec", "ziip_sec", "elapsed_sec")],
        F.sum("excp_count").alias("excp"),
    ).orderBy(F.asc_nulls_last("smf_date"), F.desc_nulls_last("cpu_sec"))


def top_cpu_consumers(smf30: DataFrame, k: int = 20) -> DataFrame:
    """The k jobs and programs with the most CPU; equal totals are ordered by name."""
    return (
        smf30.groupBy("job_name", "program_name")
        .agg(
            F.count(F.lit(1)).alias("runs"),
            rounded_sum("cpu_sec", 2).alias("total_cpu_sec"),
            round_to(F.avg("cpu_sec"), 3).alias("avg_cpu_sec"),
            round_to(F.max("cpu_sec"), 2).alias("max_cpu_sec"),
            F.sum("excp_count").alias("total_excp"),
        )
        .orderBy(
            F.desc_nulls_last("total_cpu_sec"), F.asc_nulls_last("job_name"),
            F.asc_nulls_last("program_name"),
        )
        .limit(k)
    )


def with_previous_day(smf30: DataFrame) -> DataFrame:
    """Daily CPU per job next to the CPU of the job's previous day with any activity.

    The window runs over one row per job and day: a hot job is reduced to its days before it.
    """
    daily = smf30.groupBy("smf_date", "job_name").agg(F.sum("cpu_sec").alias("cpu_sec"))
    by_day = Window.partitionBy("job_name").orderBy(F.asc_nulls_last("smf_date"))
    return daily.withColumn("prev_cpu_sec", F.lag("cpu_sec").over(by_day))


def day_over_day_movers(smf30: DataFrame, k: int = 20) -> DataFrame:
    """The k largest rises of a job's daily CPU; differences are taken before rounding."""
    delta = round_to(F.col("cpu_sec") - F.col("prev_cpu_sec"), 2)
    return (
        with_previous_day(smf30)
        .select(
            "smf_date",
            "job_name",
            round_to(F.col("cpu_sec"), 2).alias("cpu_sec"),
            round_to(F.col("prev_cpu_sec"), 2).alias("prev_cpu_sec"),
            delta.alias("delta_sec"),
        )
        .where("delta_sec is not null")
        .orderBy(
            F.desc_nulls_last("delta_sec"), F.asc_nulls_last("smf_date"),
            F.asc_nulls_last("job_name"),
        )
        .limit(k)
    )


def coverage(smf30: DataFrame) -> DataFrame:
    """Rows and CPU per date and system."""
    return smf30.groupBy("smf_date", "system_id").agg(
        F.count(F.lit(1)).alias("smf30_rows"), rounded_sum("cpu_sec", 1).alias("cpu_sec")
    ).orderBy(F.asc_nulls_last("smf_date"), F.asc_nulls_last("system_id"))


QUERIES = {
    "jobs_per_date": jobs_per_date,
    "daily_consumption": daily_consumption,
    "top_cpu_consumers": top_cpu_consumers,
    "day_over_day_movers": day_over_day_movers,
    "coverage": coverage,
}
