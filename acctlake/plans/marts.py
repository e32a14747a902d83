"""Staging view, job fact, daily aggregate and per-date report table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.functions.numbers import rounded_sum
from acctlake.functions.text import job_label, program_label
from acctlake.operators.checks import assert_checks
from acctlake.operators.mapping import dim_application
from acctlake.session import shuffles_removed
from acctlake.sources.files import read_text, remove_tree, replace_text

SECONDS = ("cpu_sec", "ziip_sec", "tcb_sec", "srb_sec", "elapsed_sec")

STAGED = (
    "customer", "job_name", "step_name", "job_id", "program_name", "smf_timestamp", "smf_date",
    "system_id", "subsystem_id", "cpu_sec", "tcb_sec", "srb_sec", "ziip_sec", "elapsed_sec",
    "excp_count", "year", "month", "source_file", "ingest_ts",
)


def stg_smf30(smf30: DataFrame) -> DataFrame:
    """Type-30 rows under their reporting names; a missing job name becomes ''.

    Input without ``ingest_ts`` is accepted, and the column is then left out.
    """
    kept = [c for c in STAGED if c in smf30.columns]
    return smf30.select(
        *[
            F.coalesce(c, F.lit("")).alias(c) if c in ("job_name", "program_name") else F.col(c)
            for c in kept
        ]
    )


def with_application(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Add application and group; the dimension has one row per (customer, job_name).

    Sums over the result whose keys hold customer and job_name would be taken where the join left the rows, and
    Spark then cannot split a hot job: such sums join their totals instead (:func:`job_totals`).
    """
    wanted = dim.select("customer", "job_name", "application", "app_group")
    return rows.join(wanted, ["customer", "job_name"], "left")


def fct_job_consumption(staged: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per job or step run with its application."""
    joined = with_application(staged, dim)
    order = (
        "customer", "application", "app_group", "system_id", "smf_date", "smf_timestamp",
        "job_name", "step_name", "job_id", "program_name", "cpu_sec", "tcb_sec", "srb_sec",
        "ziip_sec", "elapsed_sec", "excp_count", "year", "month", "source_file", "ingest_ts",
    )
    return joined.select(*[c for c in order if c in joined.columns])


def _totals(rows: DataFrame, keys: tuple[str, ...], dim: DataFrame | None) -> DataFrame:
    """Sums per key and application.

    Rows of the fact carry their application. Given the dimension instead, the rows are added up
    per job first and only the totals are joined: a job has one application per customer, so the
    result is the same, and the rows themselves are never shuffled for the join.
    """
    measures = [
        F.count(F.lit(1)).alias("step_runs"),
        *[rounded_sum(c, 3).alias(c) for c in SECONDS],
        F.sum("excp_count").alias("excp"),
    ]
    if dim is None:
        return rows.groupBy(*keys, "application", "app_group").agg(*measures)
    return with_application(rows.groupBy(*keys).agg(*measures), dim)


def job_totals(rows: DataFrame, keys: tuple[str, ...], dim: DataFrame | None,
               sums: dict[str, str], runs: str) -> DataFrame:
    """Sums per key, where keys may name ``application`` and ``app_group``.

    ``sums`` maps result columns to the columns that are added up, ``runs`` names the number of rows. Rows of the fact
    carry their application. With the dimension given, rows are added up per job first, the totals are
    joined, and added up again by the wanted keys.
    """
    first = {**{name: F.sum(column).alias(name) for name, column in sums.items()},
             runs: F.count(F.lit(1)).alias(runs)}
    again = [F.sum(name).alias(name) for name in first]
    if dim is None or not {"application", "app_group"} & set(keys):
        return rows.groupBy(*keys).agg(*first.values())
    own = [k for k in keys if k not in ("application", "app_group")]
    per_job = rows.groupBy(*dict.fromkeys([*own, "customer", "job_name"])).agg(*first.values())
    joined = with_application(per_job, dim)
    if {"customer", "job_name"} <= set(own):
        return joined.select(*keys, *first)
    return joined.groupBy(*keys).agg(*again)


class Planned(dict):
    """Models as plans. Reports over them add up staged rows and join the totals; stored models keep
    the application with each row of the fact."""

    def job_rows(self) -> tuple[DataFrame, DataFrame]:
        return self["stg_smf30"], self["dim_application"]


def job_rows(marts: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """The rows to add up per job, and the dimension if they don't carry their application."""
    return marts.job_rows() if isinstance(marts, Planned) else (marts["fct_job_consumption"], None)


_MEASURED = ("step_runs", *SECONDS, "excp")


def agg_consumption_daily(rows: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Consumption per day, customer, application, system and job, from the fact, or from staged
    rows and the dimension."""
    totals = _totals(rows, ("smf_date", "customer", "system_id", "job_name"), dim)
    return totals.select(
        "smf_date", "customer", "application", "app_group", "system_id", "job_name", *_MEASURED
    )


def rpt_jobs_by_date(rows: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Every job of every date, zero consumption included; input as for the daily aggregate.

    Unsorted: the order of the report is :func:`jobs_by_date_order`.
    """
    shown = rows.withColumns({"job_label": job_label(), "program_name": program_label()})
    keys = ("smf_date", "customer", "system_id", "job_name", "job_label", "program_name")
    return _totals(shown, keys, dim).select(
        "smf_date", "customer", "system_id", "application", "app_group", "job_name", "job_label",
        "program_name", *_MEASURED,
    )


def jobs_by_date_order() -> list[Column]:
    """Heaviest first within day and system; missing values come last in either direction."""
    return [
        F.col("smf_date").asc_nulls_last(),
        F.col("system_id").asc_nulls_last(),
        F.col("cpu_sec").desc_nulls_last(),
        F.col("job_name").asc_nulls_last(),
    ]


def define_marts(smf30: DataFrame, patterns: DataFrame) -> Planned:
    """All models as plans; nothing runs yet."""
    staged = stg_smf30(smf30)
    dim = dim_application(staged, patterns)
    fct = fct_job_consumption(staged, dim)
    return Planned(
        stg_smf30=staged,
        map_job_application=patterns,
        dim_application=dim,
        fct_job_consumption=fct,
        agg_consumption_daily=agg_consumption_daily(staged, dim),
        rpt_jobs_by_date=rpt_jobs_by_date(staged, dim),
    )


#: Columns in which many rows agree, and the bits of each in :func:`alike`.
ALIKE = {"year": 6, "month": 6, "job_name": 14, "program_name": 14, "step_name": 8, "customer": 10, "system_id": 6}


def alike(columns: list[str]) -> Column:
    """A number to sort rows by, so that those that agree in many columns stand together: they take less room in files and in a
    shuffle. It is made of hashes, since numbers are sorted faster than names; the order itself means nothing."""
    number = F.lit(0).cast("long")
    for column, bits in ALIKE.items():
        if column in columns:
            number = F.shiftleft(number, bits).bitwiseOR(F.shiftrightunsigned(F.xxhash64(column), 64 - bits))
    return number


def build_marts(spark: SparkSession, smf30: DataFrame, patterns: DataFrame, target: str,
                check: bool = True) -> dict[str, DataFrame]:
    """Build and store the models under ``target``, each replacing its last build.

    A build is written to a folder of its own, checked there, and only then becomes the current one: the
    name of its folder is put into ``<target>/CURRENT`` as a whole. The build before it stays until the next one, for readers that
    have planned on it (``<target>/PREVIOUS`` names it). If a check fails, the last build stays in use
    and the failed one is removed. Every table is written once and the next one reads it back; so are the staged rows while a build
    lasts, since ``smf30`` may be a join of large tables that the dimension, the fact and the checks would each shuffle again. They are
    sorted within tasks, since the fact's way to its month folders is the largest shuffle; shuffle files go as soon as a table is written. The fact and the
    daily aggregate are partitioned by year and month, so filters on these read only their folders.
    """
    build = f"build-{uuid.uuid4().hex}"

    def stored(name: str, df: DataFrame, *partition: str) -> DataFrame:
        path = f"{target}/{build}/{name}"
        if partition:
            # A month's rows in few files; adaptive execution splits months that are large.
            # What neighbours agree in goes first, as one stretch of bytes.
            first = [c for c in ALIKE if c in df.columns]
            moved = df.select(*first, *[c for c in df.columns if c not in first])
            df = moved.hint("rebalance", *partition).select(*df.columns)
        df.write.option("compression", "zstd").partitionBy(*partition).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    staged = stg_smf30(smf30)
    months = [c for c in ("year", "month") if c in staged.columns]
    try:
        with shuffles_removed(spark):
            rows = stored("stg_smf30", staged.sortWithinPartitions(alike(staged.columns)))
            dim = stored("dim_application", dim_application(rows, patterns))
            fct = stored("fct_job_consumption", fct_job_consumption(rows, dim), *months)
            daily = stored(
                "agg_consumption_daily",
                agg_consumption_daily(fct).withColumns(
                    {"year": F.year("smf_date"), "month": F.month("smf_date")}
                ),
                "year", "month",
            )
            stored("map_job_application", patterns)
            # range-sorted, so the files follow the report order and dates can be skipped
            stored("rpt_jobs_by_date", rpt_jobs_by_date(fct).orderBy(*jobs_by_date_order()))
            if check:
                assert_checks({
                    "stg_smf30": rows, "map_job_application": patterns, "dim_application": dim,
                    "fct_job_consumption": fct, "agg_consumption_daily": daily,
                })
            remove_tree(f"{target}/{build}/stg_smf30")
    except BaseException:
        remove_tree(f"{target}/{build}")
        raise
    last = current_build(target)
    replace_text(f"{target}/CURRENT", build)
    older = read_text(f"{target}/PREVIOUS")
    if last is not None:
        replace_text(f"{target}/PREVIOUS", last)
    if older not in (None, last, build):
        remove_tree(f"{target}/{older}")
    return {"stg_smf30": staged, **read_marts(spark, target)}


STORED = ("map_job_application", "dim_application", "fct_job_consumption", "agg_consumption_daily", "rpt_jobs_by_date")


def current_build(target: str) -> str | None:
    """The name of the build in use; None before the first."""
    return read_text(f"{target}/CURRENT")


def read_marts(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The stored models of the build in use."""
    build = current_build(target)
    if build is None:
        raise ValueError(f"no marts have been built at {target}")

    def stored(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{target}/{build}/{name}")
        # directory names are read as text
        return rows.withColumns({c: F.col(c).cast("int") for c in ("year", "month") if c in rows.columns})

    return {name: stored(name) for name in STORED}
