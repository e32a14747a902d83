"""Every operator as a query over the given tables, with the SQL that gives the same rows.

``QUERIES`` maps a name to ``fn(spark, sf_dir) -> DataFrame``; ``ORACLES`` maps it to SQL that DuckDB
runs on the same tables. Timestamps are shown without a zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctlake.fixtures import encode as E
from acctlake.fixtures import trial as T
from acctlake.fixtures.accounts import ACCT_SQL, acct, seed, seed_sql
from acctlake.fixtures.specs import SPECS
from acctlake.functions import binary as B
from acctlake.functions import text as X
from acctlake.functions.numbers import round_to, rounded_sum
from acctlake.operators import checks, mapping
from acctlake.operators import layouts as L
from acctlake.operators.decode import (
    counter_list,
    decode_table,
    sections_of,
)
from acctlake.operators.entries import section_rows
from acctlake.operators.header import decode_header
from acctlake.operators.route import records_of, route, type_counts
from acctlake.operators.sections import directory_entry, section_column
from acctlake.plans import marts as M
from acctlake.plans import queries as Q
from acctlake.plans import refresh
from acctlake.plans import reports as R
from acctlake.plans.ingest import ingest
from acctlake.session import scratch_dir
from acctlake.sources import compaction
from acctlake.sources import dataset as D
from acctlake.sources.rdw import read_records
from acctlake.sources.seed import read_seed
from acctlake.sources.sql import create_functions
from acctlake.streaming.incremental import ingest_stream, latest_copies

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_WITH_ACCT = f"WITH acct AS ({ACCT_SQL})"


def _query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# -- named models, queries and reports -----------------------------------------------------------

# One row per customer and job. Of the patterns that match the name the longest counts, of equally long ones the first
# by text; without any the job is unmapped.
_DIM_SQL = f"""
best AS (
  SELECT n.job_name, m.application, m.app_group,
         row_number() OVER (PARTITION BY n.job_name ORDER BY length(m.job_pattern) DESC, m.job_pattern) AS place
  FROM (SELECT DISTINCT job_name FROM acct) n
  JOIN {seed_sql()} ON n.job_name LIKE replace(m.job_pattern, '*', '%')),
dim AS (
  SELECT j.customer || '|' || j.job_name AS app_key, j.customer, j.job_name,
         coalesce(b.application, '(unmapped)') AS application,
         coalesce(b.app_group, 'Unassigned') AS app_group
  FROM (SELECT DISTINCT customer, job_name FROM acct) j
  LEFT JOIN best b ON b.job_name = j.job_name AND b.place = 1)"""

_FCT_SQL = """
fct AS (
  SELECT acct.* EXCLUDE (subsystem_id), dim.application, dim.app_group
  FROM acct LEFT JOIN dim USING (customer, job_name))"""

# A missing or empty name has a label of its own.
_JOB_LABEL = "coalesce(nullif(job_name, ''), '(no job name)')"
_PROGRAM_LABEL = "coalesce(nullif(program_name, ''), '(none)')"


def _sums(places: int, *columns: str) -> str:
    return ", ".join(f"round(sum({c}), {places}) AS {c}" for c in columns)


_MEASURES = (
    "CAST(count(*) AS BIGINT) AS step_runs, "
    + _sums(3, "cpu_sec", "ziip_sec", "tcb_sec", "srb_sec", "elapsed_sec")
    + ", CAST(sum(excp_count) AS BIGINT) AS excp"
)
_AGG_SQL = f"""
agg AS (
  SELECT smf_date, customer, application, app_group, system_id, job_name, {_MEASURES}
  FROM fct GROUP BY ALL)"""
_RPT_SQL = f"""
rpt AS (
  SELECT * EXCLUDE (program_label), program_label AS program_name FROM (
    SELECT smf_date, customer, system_id, application, app_group, job_name, job_label, program_label,
           {_MEASURES}
    FROM (SELECT *, {_JOB_LABEL} AS job_label, {_PROGRAM_LABEL} AS program_label FROM fct)
    GROUP BY ALL))"""
_MARTS_SQL = ",".join((_WITH_ACCT, _DIM_SQL, _FCT_SQL, _AGG_SQL, _RPT_SQL))


def _marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return M.define_marts(acct(spark, sf_dir), seed(spark))


@_query("m1_stg", f"{_WITH_ACCT} SELECT * FROM acct")
def _(spark, sf_dir):
    return _marts(spark, sf_dir)["stg_smf30"]


@_query("m2_dim_application", f"{_MARTS_SQL} SELECT * FROM dim")
def _(spark, sf_dir):
    return _marts(spark, sf_dir)["dim_application"]


@_query("m3_fct_job_consumption", f"{_MARTS_SQL} SELECT * FROM fct")
def _(spark, sf_dir):
    return _marts(spark, sf_dir)["fct_job_consumption"]


@_query("m4_agg_consumption_daily", f"{_MARTS_SQL} SELECT * FROM agg")
def _(spark, sf_dir):
    return _marts(spark, sf_dir)["agg_consumption_daily"]


@_query("m5_rpt_jobs_by_date", f"{_MARTS_SQL} SELECT * FROM rpt")
def _(spark, sf_dir):
    return _marts(spark, sf_dir)["rpt_jobs_by_date"].orderBy(*M.jobs_by_date_order())


_DAY_SUMS = _sums(2, "cpu_sec", "ziip_sec", "elapsed_sec")


@_query("q0", f"""{_WITH_ACCT}, shown AS (
  SELECT * REPLACE ({_JOB_LABEL} AS job_name, {_PROGRAM_LABEL} AS program_name) FROM acct)
SELECT smf_date, system_id, job_name, program_name, CAST(count(*) AS BIGINT) AS step_runs, {_DAY_SUMS},
       CAST(sum(excp_count) AS BIGINT) AS excp
FROM shown GROUP BY ALL""")
def _(spark, sf_dir):
    return Q.jobs_per_date(acct(spark, sf_dir))


@_query("q1", f"""{_WITH_ACCT}
SELECT smf_date, system_id, job_name, CAST(count(*) AS BIGINT) AS step_runs, {_DAY_SUMS},
       CAST(sum(excp_count) AS BIGINT) AS excp
FROM acct GROUP BY ALL""")
def _(spark, sf_dir):
    return Q.daily_consumption(acct(spark, sf_dir))


@_query("q2", f"""{_WITH_ACCT}
SELECT job_name, program_name, CAST(count(*) AS BIGINT) AS runs,
       round(sum(cpu_sec), 2) AS total_cpu_sec, round(avg(cpu_sec), 3) AS avg_cpu_sec,
       round(max(cpu_sec), 2) AS max_cpu_sec, CAST(sum(excp_count) AS BIGINT) AS total_excp
FROM acct GROUP BY job_name, program_name
ORDER BY total_cpu_sec DESC, job_name, program_name LIMIT 20""")
def _(spark, sf_dir):
    return Q.top_cpu_consumers(acct(spark, sf_dir))


_LAG_SQL = """,
lagged AS (
  SELECT smf_date, job_name, sum(cpu_sec) AS cpu_sec,
         lag(sum(cpu_sec)) OVER (PARTITION BY job_name ORDER BY smf_date) AS prev_cpu_sec
  FROM acct GROUP BY smf_date, job_name)"""


@_query("q3", f"""{_WITH_ACCT}{_LAG_SQL}
SELECT smf_date, job_name, round(cpu_sec, 2) AS cpu_sec, round(prev_cpu_sec, 2) AS prev_cpu_sec,
       round(cpu_sec - prev_cpu_sec, 2) AS delta_sec
FROM lagged WHERE cpu_sec - prev_cpu_sec IS NOT NULL
ORDER BY delta_sec DESC, smf_date, job_name LIMIT 20""")
def _(spark, sf_dir):
    return Q.day_over_day_movers(acct(spark, sf_dir))


@_query("q4", f"""{_WITH_ACCT}
SELECT smf_date, system_id, CAST(count(*) AS BIGINT) AS smf30_rows, round(sum(cpu_sec), 1) AS cpu_sec
FROM acct GROUP BY ALL""")
def _(spark, sf_dir):
    return Q.coverage(acct(spark, sf_dir))


@_query("r1_jobs_by_date", f"""{_MARTS_SQL}
SELECT smf_date, customer, system_id, application, job_label AS job_name, program_name, step_runs,
       cpu_sec, ziip_sec, elapsed_sec, excp FROM rpt""")
def _(spark, sf_dir):
    return R.jobs_by_date(_marts(spark, sf_dir))


@_query("r2_consumption_daily", f"""{_MARTS_SQL}
SELECT smf_date, customer, application, app_group, system_id, job_name, step_runs, cpu_sec,
       ziip_sec, elapsed_sec, excp FROM agg""")
def _(spark, sf_dir):
    return R.consumption_daily(_marts(spark, sf_dir))


@_query("r3_top_consumers", f"""{_MARTS_SQL}
SELECT customer, application, job_name, program_name, CAST(count(*) AS BIGINT) AS runs,
       round(sum(cpu_sec), 2) AS total_cpu_sec, CAST(sum(excp_count) AS BIGINT) AS total_excp
FROM fct GROUP BY ALL
ORDER BY total_cpu_sec DESC, customer, application, job_name, program_name LIMIT 100""")
def _(spark, sf_dir):
    return R.top_consumers(_marts(spark, sf_dir))


@_query("r4_consumption_by_application", f"""{_MARTS_SQL}
SELECT customer, application, app_group, round(sum(cpu_sec), 2) AS cpu_sec,
       round(sum(ziip_sec), 2) AS ziip_sec, CAST(sum(step_runs) AS BIGINT) AS step_runs
FROM agg GROUP BY ALL""")
def _(spark, sf_dir):
    return R.consumption_by_application(_marts(spark, sf_dir))


@_query("r5_metric_by_dimension", f"""{_MARTS_SQL},
totals AS (SELECT application AS k, sum(cpu_sec) AS v FROM agg WHERE cpu_sec IS NOT NULL
           GROUP BY 1 HAVING sum(cpu_sec) > 0)
SELECT k, v, round(v / sum(v) OVER (), 9) AS share FROM totals""")
def _(spark, sf_dir):
    chart = R.metric_by_dimension(_marts(spark, sf_dir)["agg_consumption_daily"])
    return chart.withColumn("share", round_to(F.col("share"), 9))


for _depth, _name in enumerate(("customer", "application", "job", "step"), start=1):
    _levels = R.DRILL_PATH[:_depth]

    @_query(f"r6_drill_{_name}", f"""{_MARTS_SQL}
    SELECT {', '.join(_levels)}, CAST(count(*) AS BIGINT) AS step_runs, {_DAY_SUMS},
           CAST(sum(excp_count) AS BIGINT) AS excp
    FROM fct GROUP BY {', '.join(_levels)}""")
    def _(spark, sf_dir, levels=_levels):
        rows, dim = M.job_rows(_marts(spark, sf_dir))
        return R.drill(rows, levels, dim=dim)


@_query("r6_drill_filtered", f"""{_MARTS_SQL}
SELECT application, job_name, CAST(count(*) AS BIGINT) AS step_runs, {_DAY_SUMS},
       CAST(sum(excp_count) AS BIGINT) AS excp
FROM fct WHERE customer = 'NATION_7' AND system_id = 'SYS1'
  AND smf_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
GROUP BY application, job_name""")
def _(spark, sf_dir):
    import datetime as dt

    rows, dim = M.job_rows(_marts(spark, sf_dir))
    return R.drill(
        rows, ("application", "job_name"), dim=dim,
        customer="NATION_7", system_id="SYS1", first=dt.date(1996, 1, 1), last=dt.date(1998, 12, 31),
    )


_CHECK_SQL = " UNION ALL ".join(
    [
        f"SELECT '{m}' AS model, 'not_null' AS \"check\", '{c}' AS column_name, "
        f"CAST(count(*) FILTER ({c} IS NULL) AS BIGINT) AS failures FROM {t}"
        for m, t in (("stg_smf30", "acct"), ("dim_application", "dim"), ("fct_job_consumption", "fct"),
                     ("agg_consumption_daily", "agg"), ("map_job_application", "seed"))
        for c in checks.NOT_NULL[m]
    ]
    + [
        f"SELECT '{m}', 'unique', '{c}', CAST(count(*) AS BIGINT) FROM "
        f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1) d"
        for m, t in (("dim_application", "dim"), ("map_job_application", "seed"))
        for c in checks.UNIQUE[m]
    ]
)


@_query("k_checks", f"{_MARTS_SQL}, seed AS (SELECT * FROM {seed_sql()}) {_CHECK_SQL}")
def _(spark, sf_dir):
    return checks.run_checks(_marts(spark, sf_dir))


# -- joins, windows, aggregates, scalars ---------------------------------------------------------


def _jobs(spark, sf_dir) -> DataFrame:
    return acct(spark, sf_dir).select("customer", "job_name").distinct()


@_query("j01_like_join", f"""{_WITH_ACCT}, jobs AS (SELECT DISTINCT customer, job_name FROM acct)
SELECT j.customer, j.job_name, m.job_pattern, m.application, m.app_group
FROM jobs j JOIN {seed_sql()} ON j.job_name LIKE replace(m.job_pattern, '*', '%')""")
def _(spark, sf_dir):
    return mapping.pattern_matches(_jobs(spark, sf_dir), seed(spark))


@_query("w01_most_specific", f"""{_WITH_ACCT}, {_DIM_SQL.lstrip()}
SELECT DISTINCT customer, job_name, best.application, best.app_group
FROM acct JOIN best USING (job_name) WHERE best.place = 1""")
def _(spark, sf_dir):
    matches = mapping.pattern_matches(_jobs(spark, sf_dir), seed(spark))
    return mapping.most_specific(matches, "customer", "job_name").drop("job_pattern")


@_query("j02_left_join_rn", f"""{_WITH_ACCT}, {_DIM_SQL.lstrip()}
SELECT DISTINCT customer, job_name, first.application, first.app_group
FROM acct LEFT JOIN (SELECT * FROM best WHERE place = 1) first USING (job_name)""")
def _(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    best = mapping.most_specific(
        mapping.pattern_matches(jobs, seed(spark)), "customer", "job_name"
    ).drop("job_pattern")
    return jobs.join(best, ["customer", "job_name"], "left")


@_query("j03_fact_dim", f"""{_MARTS_SQL}
SELECT application, app_group, CAST(count(*) AS BIGINT) AS n, round(sum(cpu_sec), 2) AS cpu_sec
FROM fct GROUP BY ALL""")
def _(spark, sf_dir):
    return _marts(spark, sf_dir)["fct_job_consumption"].groupBy("application", "app_group").agg(
        F.count(F.lit(1)).alias("n"), rounded_sum("cpu_sec", 2).alias("cpu_sec")
    )


@_query("p07_glob_like", f"""SELECT m.job_pattern, p.p_partkey, p.p_brand
FROM part p JOIN {seed_sql()} ON p.p_brand LIKE replace(m.job_pattern, '*', '%')""")
def _(spark, sf_dir):
    brands = T.source_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return mapping.pattern_matches(brands, seed(spark), "p_brand").select(
        "job_pattern", "p_partkey", "p_brand"
    )


@_query("p10_distinct", f"{_WITH_ACCT} SELECT DISTINCT customer, job_name FROM acct")
def _(spark, sf_dir):
    return _jobs(spark, sf_dir)


@_query("w02_lag", f"{_WITH_ACCT}{_LAG_SQL} SELECT * FROM lagged")
def _(spark, sf_dir):
    return Q.with_previous_day(acct(spark, sf_dir))


@_query("a02_group_all", f"""{_WITH_ACCT}
SELECT system_id, year, month, CAST(count(*) AS BIGINT) AS n, max(cpu_sec) AS max_cpu,
       avg(cpu_sec) AS avg_cpu FROM acct GROUP BY ALL""")
def _(spark, sf_dir):
    return spark.sql(
        "SELECT system_id, year, month, count(*) AS n, max(cpu_sec) AS max_cpu, "
        "avg(cpu_sec) AS avg_cpu FROM {acct} GROUP BY ALL",
        acct=acct(spark, sf_dir),
    )


@_query("a08_type_counts", "SELECT CAST(30 AS INTEGER) AS record_type, CAST(4 AS INTEGER) AS subtype, "
        "'smf30' AS table_name, CAST(count(*) AS BIGINT) AS records FROM events UNION ALL "
        + " UNION ALL ".join(
            f"SELECT {t}, {s}, '{name}', CAST(count(*) AS BIGINT) FROM {source}"
            for t, s, name, source in (
                (70, 1, "smf70-1", "part"), (71, 1, "smf71-1", "part"), (1154, 2, "smf1154-2", "orders"),
                (72, 1, "smf72-1", "supplier"), (113, 255, "smf113-255", "supplier"),
                (113, 0, "smf113-0", "supplier"), (250, 0, "raw", "supplier"))))
def _(spark, sf_dir):
    return type_counts(route(read_records(spark, _routing_log(spark, sf_dir))))


@_query("e12_strings", """SELECT p_partkey, replace(p_brand, '#', '*') AS pattern,
CAST(length(p_name) AS INTEGER) AS name_length, p_brand || '|' || p_type AS joined FROM part""")
def _(spark, sf_dir):
    return T.source_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.replace("p_brand", F.lit("#"), F.lit("*")).alias("pattern"),
        F.length("p_name").alias("name_length"),
        F.concat("p_brand", F.lit("|"), "p_type").alias("joined"),
    )


@_query("e13_null_label", f"""{_WITH_ACCT}
SELECT job_id, step_name, {_JOB_LABEL} AS job_label, {_PROGRAM_LABEL} AS program_label FROM acct""")
def _(spark, sf_dir):
    return acct(spark, sf_dir).select(
        "job_id", "step_name", X.job_label().alias("job_label"), X.program_label().alias("program_label")
    )


@_query("e14_round", """SELECT l_orderkey, l_linenumber, l_partkey,
round(l_extendedprice, 1) AS r1, round(l_extendedprice - l_quantity, 0) AS r0,
round(-l_extendedprice / 8, 2) AS negative FROM lineitem""")
def _(spark, sf_dir):
    price = F.col("l_extendedprice")
    return T.source_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", round_to(price, 1).alias("r1"),
        round_to(price - F.col("l_quantity"), 0).alias("r0"), round_to(-price / 8, 2).alias("negative"),
    )


@_query("e16_date_parts", """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year,
strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%Y%m%d') AS day_text,
strftime(o_orderdate, '%Y-%m-%d') AS iso_text FROM orders""")
def _(spark, sf_dir):
    parts = X.date_parts(F.col("o_orderdate").cast("date"))
    return T.source_table(spark, sf_dir, "orders").select(
        "o_orderkey", *[v.alias(k) for k, v in parts.items()]
    )


_SAFE = "CASE WHEN {0} = '' THEN 'UNKNOWN' ELSE regexp_replace({0}, '[^A-Za-z0-9]', '_', 'g') END"


@_query("s12_sanitize", f"""{_WITH_ACCT}
SELECT DISTINCT customer, job_name, smf_date, {_SAFE.format('job_name')} AS safe,
  {_SAFE.format('customer')} || '/' || {_SAFE.format('job_name')} || '/year=' || strftime(smf_date, '%Y')
  || '/month=' || strftime(smf_date, '%m') || '/SMF74-1-' || strftime(smf_date, '%Y%m%d')
  || '-R1.parquet' AS path FROM acct""")
def _(spark, sf_dir):
    return acct(spark, sf_dir).select("customer", "job_name", "smf_date").distinct().select(
        "*",
        X.sanitize(F.col("job_name")).alias("safe"),
        D.dataset_path(F.col("customer"), F.col("job_name"), F.col("smf_date"), F.lit("smf74-1"),
                       F.lit("R1")).alias("path"),
    )


# -- binary fields: encoded by test expressions, read by the real ones ---------------------------


def _cells(spark, sf_dir, source, **cells: Column) -> DataFrame:
    """One binary column ``b`` per source row, cut from hexadecimal text."""
    rows = T.source_table(spark, sf_dir, source)
    return rows.select("*", F.unhex(F.concat(*cells.values())).alias("b"))


@_query("e01_uint", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(l_linenumber AS SMALLINT) AS v8, CAST(l_suppkey % 65536 AS INTEGER) AS v16,
CAST(round(l_extendedprice * 100) AS BIGINT) AS v32, CAST(4294967295 - l_partkey AS BIGINT) AS top32,
CAST(0 AS BIGINT) AS beyond FROM lineitem""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "lineitem", a=E.number("l_linenumber", 1), c=E.number("l_suppkey % 65536", 2),
        d=E.number("CAST(round(l_extendedprice * 100) AS BIGINT)", 4),
        e=E.number("4294967295 - l_partkey", 4),
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", B.u8(b, 0).alias("v8"), B.u16(b, 1).alias("v16"),
        B.u32(b, 3).alias("v32"), B.u32(b, 7).alias("top32"), B.u32(b, 9).alias("beyond"),
    )


@_query("e02_u64", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(CAST(18446744073709551615 AS DECIMAL(20,0)) - l_orderkey AS DECIMAL(20,0)) AS top,
CAST(l_partkey AS DECIMAL(20,0)) AS low FROM lineitem""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "lineitem",
        a=E.number("CAST(18446744073709551615 AS DECIMAL(20,0)) - l_orderkey", 8),
        c=E.number("l_partkey", 8),
    ).select("l_orderkey", "l_linenumber", "l_partkey", B.u64(b, 0).alias("top"), B.u64(b, 8).alias("low"))


@_query("e03_ebcdic", """SELECT p_partkey, p_name AS name, p_brand AS brand, upper(p_type) AS kind
FROM part""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "part", a=E.ebcdic("p_name", 60), c=E.ebcdic("p_brand", 12),
        d=E.ebcdic("upper(p_type)", 30), e=E.filler(4),
    ).select(
        "p_partkey", B.text(b, 0, 60).alias("name"), B.text(b, 60, 12).alias("brand"),
        # runs over the trailing NULs and the end of the record
        B.text(b, 72, 80).alias("kind"),
    )


@_query("e04_packed_date", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS good,
CAST(NULL AS DATE) AS zero, CAST(NULL AS DATE) AS day_zero, CAST(NULL AS DATE) AS letters,
CASE WHEN year(o_orderdate) % 4 = 0 THEN make_date(year(o_orderdate), 12, 31) END AS day_366
FROM orders""")
def _(spark, sf_dir):
    b = F.col("b")
    year = F.lpad(F.year("o_orderdate").cast("string"), 4, "0")
    return _cells(
        spark, sf_dir, "orders", a=E.packed_date("CAST(o_orderdate AS DATE)"), c=F.lit("0000000C"),
        d=F.concat(year, F.lit("000C")), e=F.concat(year, F.lit("1A0C")), f=F.concat(year, F.lit("366C")),
    ).select(
        "o_orderkey", B.packed_date(b, 0).alias("good"), B.packed_date(b, 4).alias("zero"),
        B.packed_date(b, 8).alias("day_zero"), B.packed_date(b, 12).alias("letters"),
        B.packed_date(b, 16).alias("day_366"),
    )


@_query("e05_timestamp", """SELECT event_id,
date_trunc('day', ts) + to_microseconds((CAST(hour(ts) AS BIGINT) * 360000 + minute(ts) * 6000
+ second(ts) * 100) * 10000) AS t FROM events""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "events", a=E.packed_date("CAST(ts AS DATE)"),
        c=E.number("hour(ts) * 360000 + minute(ts) * 6000 + second(ts) * 100", 4),
    ).select(
        "event_id", B.day_time(B.packed_date(b, 0), B.u32(b, 4)).cast("timestamp_ntz").alias("t")
    )


@_query("e06_units", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS sec,
CAST(round(l_extendedprice * 100) AS BIGINT) * 10 AS ms, CAST(10779525760 AS BIGINT) AS wide
FROM lineitem""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "lineitem", a=E.number("CAST(round(l_extendedprice * 100) AS BIGINT)", 4),
        c=F.lit("40404040"),
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", B.seconds(B.u32(b, 0)).alias("sec"),
        B.millis(B.u32(b, 0)).alias("ms"), B.millis(B.u32(b, 4)).alias("wide"),
    )


@_query("e07_hexfloat", """SELECT l_orderkey, l_linenumber, l_partkey,
CAST(round(l_extendedprice * 100) AS BIGINT) / 16.0 AS v, -l_quantity / 16.0 AS negative,
CAST(0 AS DOUBLE) AS zero FROM lineitem""")
def _(spark, sf_dir):
    b = F.col("b")
    positive = E.hexfloat("l_quantity")
    flipped = F.concat(
        F.hex(F.conv(F.substring(positive, 1, 2), 16, 10).cast("bigint") + F.lit(128)),
        F.substring(positive, 3, 14),
    )
    return _cells(
        spark, sf_dir, "lineitem", a=E.hexfloat("round(l_extendedprice * 100)"), c=flipped,
        d=E.filler(8),
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey", B.hexfloat(b, 0).alias("v"),
        B.hexfloat(b, 8).alias("negative"), B.hexfloat(b, 16).alias("zero"),
    )


@_query("e08_hex_text", """SELECT l_orderkey, l_linenumber, l_partkey,
upper(right(concat('0', to_hex(l_partkey % 256)), 2)) AS two,
upper(right(concat('000', to_hex(l_partkey % 65536)), 4)) AS four FROM lineitem""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "lineitem", a=E.number("l_partkey % 256", 1), c=E.number("l_partkey % 65536", 2)
    ).select("l_orderkey", "l_linenumber", "l_partkey", B.hex_text(b, 0, 1).alias("two"),
             B.hex_text(b, 1, 2).alias("four"))


@_query("e09_bool_char", """SELECT o_orderkey, (o_custkey % 3) <> 0 AS yes, o_orderstatus AS code
FROM orders""")
def _(spark, sf_dir):
    b = F.col("b")
    return _cells(
        spark, sf_dir, "orders", a=E.number("o_custkey % 3", 1), c=E.ebcdic("o_orderstatus", 1)
    ).select("o_orderkey", B.flag(b, 0).alias("yes"), B.text(b, 1, 1).alias("code"))


@_query("p04_bit_filter", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE ((l_partkey % 256) & 2) <> 0""")
def _(spark, sf_dir):
    cells = _cells(spark, sf_dir, "lineitem", a=E.number("l_partkey % 256", 1))
    return cells.where(B.bit_set(B.uint(F.col("b"), 0, 1), 0x02)).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


# -- records -------------------------------------------------------------------------------------


def _routing_log(spark, sf_dir) -> str:
    def make() -> DataFrame:
        parts = [T.spec_records(spark, sf_dir, t) for t in ("smf30", "smf70-1", "smf71-1", "smf1154-2")]
        parts += [
            T.header_only_records(spark, sf_dir, t, s) for t, s in ((72, 1), (113, 255), (113, 0), (250, 7))
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    return T.written_log(spark, (sf_dir, "routing"), make)


@_query("s01_record_split", "SELECT CAST(138 AS INTEGER) AS size, CAST(event_id AS BIGINT) AS event_id, "
        "CAST(1 AS BIGINT) AS copies FROM events")
def _(spark, sf_dir):
    # The read count sits 8 bytes into the I/O section, whose place the directory gives.
    frames = read_records(spark, T.table_log(spark, sf_dir, "smf30"))
    entry = directory_entry(F.col("body"), 22 + 2 * 12)
    return (
        frames.where("error is null")
        .select(F.length("body").alias("size"), B.u32(F.col("body"), entry["offset"]).alias("event_id"))
        .groupBy("size", "event_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


_HEADER_SQL = ("SELECT {time} AS smf_timestamp, rec_date AS smf_date, rec_system AS system_id, "
               "{subsystem} AS subsystem_id, CAST({type} AS INTEGER) AS record_type, "
               "CAST({subtype} AS INTEGER) AS subtype, CAST(0 AS SMALLINT) AS flags FROM {source}")
_HEADER_COLUMNS = ("smf_timestamp", "smf_date", "system_id", "subsystem_id", "record_type", "subtype",
                   "flags")


@_query("s02_header", _HEADER_SQL.format(time=T.RECORD_TIME_SQL, subsystem="'JES2'", type=30, subtype=4,
                                         source=T.source_sql("events")))
def _(spark, sf_dir):
    frames = read_records(spark, T.table_log(spark, sf_dir, "smf30"))
    return T.comparable(decode_header(frames), *_HEADER_COLUMNS)


@_query("s03_ext_header", _HEADER_SQL.format(time=T.RECORD_TIME_SQL, subsystem="''", type=1154,
                                             subtype=2, source=T.source_sql("orders")))
def _(spark, sf_dir):
    frames = read_records(spark, T.table_log(spark, sf_dir, "smf1154-2"))
    return T.comparable(decode_header(frames), *_HEADER_COLUMNS)


@_query("s04_subtype", "SELECT s_suppkey, CAST(s_suppkey % 300 AS INTEGER) AS subtype, "
        "CAST(0 AS INTEGER) AS none FROM supplier")
def _(spark, sf_dir):
    rows = E.with_record_values(T.source_table(spark, sf_dir, "supplier"), "supplier")
    full = F.unhex(F.replace(E.record_header(72, "s_suppkey % 300"), F.lit("____"), F.lit("0016")))
    return rows.select("s_suppkey", B.u16(full, 20).alias("subtype"),
                       B.u16(F.substring(full, 1, 20), 20).alias("none"))


@_query("p01_route", ORACLES["a08_type_counts"])
def _(spark, sf_dir):
    routed = route(read_records(spark, _routing_log(spark, sf_dir)))
    parts = [
        records_of(routed, t).select("record_type", "subtype", F.lit(t).alias("table_name"))
        for t in ("smf30", "smf70-1", "smf71-1", "smf1154-2", "smf72-1", "smf113-255", "smf113-0", "raw")
    ]
    return D.union_by_name(parts).groupBy("record_type", "subtype", "table_name").agg(
        F.count(F.lit(1)).alias("records")
    )


@_query("p02_dual_route", "SELECT 'smf74-2p' AS table_name, CAST(sum(CAST(round(l_extendedprice * 100) AS "
        "BIGINT)) AS BIGINT) AS signals, CAST(count(*) AS BIGINT) AS entries FROM lineitem UNION ALL "
        "SELECT 'smf74-2m', CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT), CAST(count(*) AS BIGINT) "
        "FROM lineitem")
def _(spark, sf_dir):
    routed = route(read_records(spark, T.table_log(spark, sf_dir, "smf74-2p")))
    return D.union_by_name(
        [
            decode_table(records_of(routed, t), t).agg(
                F.lit(t).alias("table_name"), F.sum("signals_sent").alias("signals"),
                F.count(F.lit(1)).alias("entries"))
            for t in ("smf74-2p", "smf74-2m")
        ]
    )


def _sectioned(spark, sf_dir, table: str) -> DataFrame:
    routed = route(read_records(spark, T.table_log(spark, sf_dir, table)))
    return sections_of(records_of(routed, table), L.BY_TABLE[table])


@_query("d01_triplet", """SELECT p_partkey, CAST(98 AS BIGINT) AS first_offset, CAST(48 AS BIGINT) AS
first_length, CAST(1 AS BIGINT) AS first_count, CAST(3 AS BIGINT) AS short_count,
CAST(0 AS BIGINT) AS outside_count FROM part""")
def _(spark, sf_dir):
    # a wide entry, an entry that claims more than the record holds, one that points outside it
    directory = F.concat(
        F.lit("00" * 22), F.lit(f"{98:08X}{48:08X}{1:08X}"), F.lit(f"{146:08X}{20:08X}{999:08X}"),
        F.lit(f"{9999:08X}{32:08X}{1:08X}"), F.lit("00" * 40), F.lit("00" * 48),
        E.number("p_partkey", 60),
    )
    rows = T.source_table(spark, sf_dir, "part").select("p_partkey", F.unhex(directory).alias("body"))
    body = F.col("body")
    found = rows.select(
        "p_partkey", directory_entry(body, 22).alias("a"), directory_entry(body, 34).alias("b"),
        directory_entry(body, 46).alias("c"),
    )
    return found.select(
        "p_partkey", F.col("a.offset").alias("first_offset"), F.col("a.length").alias("first_length"),
        F.col("a.count").alias("first_count"), F.col("b.count").alias("short_count"),
        F.col("c.count").alias("outside_count"),
    )


@_query("d02_explode", """SELECT rec_system AS system_id, l_linenumber AS period_num,
CAST(count(*) AS BIGINT) AS entries FROM """ + T.source_sql("lineitem") + " GROUP BY 1, 2")
def _(spark, sf_dir):
    number = L.Field("period_num", "u32", "row", 0)
    return (
        section_rows(_sectioned(spark, sf_dir, "smf72-3"), (number,))
        .groupBy("system_id", F.col("period_num").cast("int").alias("period_num"))
        .agg(F.count(F.lit(1)).alias("entries"))
    )


@_query("d04_nested", """SELECT CAST(o_orderkey AS VARCHAR) AS request_id, CAST(136 AS BIGINT) AS
nested_offset, CAST(112 AS BIGINT) AS nested_length FROM orders""")
def _(spark, sf_dir):
    body = F.col("body")
    return _sectioned(spark, sf_dir, "smf1154-2").select(
        B.text(body, F.col("_s0.offset") + F.lit(32), 8).alias("request_id"),
        F.col("_row.offset").alias("nested_offset"), F.col("_row.length").alias("nested_length"),
    )


@_query("d05_array", """SELECT p_size AS cpu_id, CAST(1 + p_size % 4 AS INTEGER) AS n,
CAST(CASE WHEN p_size % 4 >= 1 THEN p_partkey END AS DECIMAL(20,0)) AS second FROM part""")
def _(spark, sf_dir):
    counters = counter_list(F.col("body"), section_column("_s2"))
    ids = _sectioned(spark, sf_dir, "smf113").select(
        B.u16(F.col("body"), F.col("_s1.offset") + F.lit(14)).alias("cpu_id"), counters.alias("c")
    )
    return ids.select("cpu_id", F.size("c").alias("n"), F.get("c", F.lit(1)).alias("second"))


@_query("d06_array_agg", """SELECT CAST(sum(2 - p_size % 2) AS BIGINT) AS cp,
CAST(sum(1 + p_size % 2) AS BIGINT) AS ziip,
CAST(sum((p_partkey + CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END) * 10) AS BIGINT) AS cp_wait
FROM part""")
def _(spark, sf_dir):
    routed = route(read_records(spark, T.table_log(spark, sf_dir, "smf70-1")))
    return decode_table(records_of(routed, "smf70-1"), "smf70-1").agg(
        F.sum("cp_count").alias("cp"), F.sum("ziip_lp_count").alias("ziip"),
        F.sum("cp_wait_ms").alias("cp_wait"),
    )


for _number, _table in enumerate(SPECS, start=1):

    @_query(f"t{_number:02d}_{_table.replace('-', '_')}", T.table_sql(_table))
    def _(spark, sf_dir, table=_table):
        return T.table_rows(spark, sf_dir, table)


@_query("t29_header_only", " UNION ALL ".join(
    _HEADER_SQL.format(time=T.RECORD_TIME_SQL, subsystem="'JES2'", type=t, subtype=s,
                       source=T.source_sql("supplier")).replace(
        "SELECT ", f"SELECT 'smf{t}-{s}' AS table_name, ", 1)
    for t, s in ((72, 1), (113, 255))))
def _(spark, sf_dir):
    routed = route(read_records(spark, _routing_log(spark, sf_dir)))
    names = ("smf72-1", "smf113-255")
    rows = decode_table(routed.where(F.col("table_name").isin(*names)), "header", keep=("table_name",))
    return T.comparable(rows, "table_name", *_HEADER_COLUMNS)


@_query("t30_raw", f"""SELECT {T.RECORD_TIME_SQL} AS smf_timestamp, CAST(250 AS INTEGER) AS record_type,
CAST(0 AS INTEGER) AS subtype, upper(right(concat('000000000000000', to_hex(s_suppkey)), 16)) AS tail,
CAST(30 AS INTEGER) AS size FROM {T.source_sql('supplier')}""")
def _(spark, sf_dir):
    routed = route(read_records(spark, _routing_log(spark, sf_dir)))
    rows = decode_table(records_of(routed, "raw"), "raw")
    shown = rows.withColumn("tail", F.hex(F.substring("body", -8, 8))).withColumn("size", F.length("body"))
    return T.comparable(shown, "smf_timestamp", "record_type", "subtype", "tail", "size")


# -- dataset -------------------------------------------------------------------------------------


_STORED: dict[tuple, str] = {}


def _once(spark, key: tuple, make: Callable[[str], None]) -> str:
    """Folder of a dataset built from the given tables, made once per session."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _STORED:
        root = scratch_dir(spark, "lake")
        make(root)
        _STORED[key] = root
    return _STORED[key]


#: Orders as accounting rows; their priorities stand for customers and need sanitising.
_ORDER_VALUES = {
    "owner": "o_orderpriority",
    "system_id": "concat('SYS', o_custkey % 2)",
    "smf_date": "CAST(o_orderdate AS DATE)",
    "job_id": "concat('JOB', o_orderkey)",
    "elapsed_sec": "o_totalprice",
    "excp_count": "o_custkey",
}
_WITH_STORED = (
    "WITH base AS (SELECT "
    + ", ".join(f"{v} AS {k}" for k, v in _ORDER_VALUES.items())
    + " FROM orders), stored AS (SELECT *, regexp_replace(owner, '[^A-Za-z0-9]', '_', 'g') AS customer, "
    "system_id AS path_system_id, strftime(smf_date, '%Y') AS year, strftime(smf_date, '%m') AS month "
    "FROM base)"
)


def _order_rows(spark, sf_dir) -> DataFrame:
    orders = T.source_table(spark, sf_dir, "orders")
    return orders.select(*[F.expr(v).alias(k) for k, v in _ORDER_VALUES.items()])


def _stored(spark, sf_dir) -> str:
    def make(root: str) -> None:
        rows = D.with_partitions(_order_rows(spark, sf_dir), F.col("owner")).drop("owner")
        D.write_table(
            D.clustered(rows.withColumn("run_id", F.lit("R1")), "customer", "path_system_id"),
            f"{root}/smf30",
        )

    return _once(spark, (sf_dir, "orders"), make)


_SHOWN = "job_id, smf_date, system_id, elapsed_sec, excp_count"
_SHOWN_COLUMNS = _SHOWN.split(", ")


@_query("s05_scan_type", f"{_WITH_STORED} SELECT customer, {_SHOWN} FROM stored "
        "WHERE system_id = 'SYS1' AND year = '1997'")
def _(spark, sf_dir):
    rows = D.read_type(spark, _stored(spark, sf_dir), "smf30")
    return rows.where("path_system_id = 'SYS1' and year = '1997'").select("customer", *_SHOWN_COLUMNS)


@_query("s06_union_by_name", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS parent FROM nation "
        "UNION ALL SELECT r_regionkey, r_name, NULL FROM region "
        "UNION ALL SELECT n_nationkey, NULL, n_regionkey FROM nation")
def _(spark, sf_dir):
    nation, region = (T.source_table(spark, sf_dir, t) for t in ("nation", "region"))
    first = nation.selectExpr("n_nationkey as id", "n_name as name", "n_regionkey as parent")
    path = scratch_dir(spark, "drift")
    region.selectExpr("r_regionkey as id", "r_name as name").write.parquet(f"{path}/v=1")
    first.drop("name").write.parquet(f"{path}/v=2")
    drifted = spark.read.option("mergeSchema", True).parquet(path).drop("v")
    return D.union_by_name([first, drifted])


@_query("s07_partition_cols", f"{_WITH_STORED} SELECT customer, path_system_id, year, month, "
        "CAST(count(*) AS BIGINT) AS n FROM stored GROUP BY ALL")
def _(spark, sf_dir):
    rows = D.read_table(spark, _stored(spark, sf_dir), "smf30")
    return rows.groupBy("customer", "path_system_id", "year", "month").agg(F.count(F.lit(1)).alias("n"))


@_query("s08_path_dims", f"{_WITH_STORED} SELECT customer, path_system_id, CAST(year AS INTEGER) AS year, "
        f"CAST(month AS INTEGER) AS month, {_SHOWN} FROM stored")
def _(spark, sf_dir):
    rows = D.read_nested(spark, f"{_stored(spark, sf_dir)}/smf30", "part")
    return rows.select("customer", "path_system_id", "year", "month", *_SHOWN_COLUMNS)


def _ingested(spark, sf_dir) -> str:
    return _once(
        spark, (sf_dir, "ingested"),
        lambda root: ingest(spark, _routing_log(spark, sf_dir), root, customer="ACME Inc."),
    )


@_query("s09_type_views", "SELECT 'smf70' AS view, CAST(count(*) AS BIGINT) AS n FROM part "
        "UNION ALL SELECT 'smf113', CAST(count(*) * 2 AS BIGINT) FROM supplier "
        "UNION ALL SELECT 'smf1154', CAST(count(*) AS BIGINT) FROM orders "
        "UNION ALL SELECT 'raw', CAST(count(*) AS BIGINT) FROM supplier")
def _(spark, sf_dir):
    D.create_views(spark, _ingested(spark, sf_dir))
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{v}' AS view, count(*) AS n FROM {v}" for v in ("smf70", "smf113", "smf1154", "raw")
        )
    )


@_query("f01_read_smf_sql", f"{_WITH_STORED} SELECT 'smf30' AS table_name, customer, {_SHOWN} FROM stored "
        f"WHERE year = '1997' AND month = '03' UNION ALL SELECT 'own', customer, {_SHOWN} FROM stored WHERE system_id = 'SYS1'")
def _(spark, sf_dir):
    create_functions(spark, _stored(spark, sf_dir))
    return spark.sql(
        f"SELECT table_name, customer, {_SHOWN} FROM read_smf('smf30', year => 1997, month => 3) "
        f"UNION ALL SELECT 'own', customer, {_SHOWN} FROM read_smf30(system => 'SYS1')"
    )


@_query("f01_read_smf_types", "SELECT 'smf70' AS type, CAST(count(*) AS BIGINT) AS n FROM part "
        "UNION ALL SELECT 'smf113', CAST(count(*) * 2 AS BIGINT) FROM supplier "
        "UNION ALL SELECT 'smf1154', CAST(count(*) AS BIGINT) FROM orders "
        "UNION ALL SELECT 'raw', CAST(count(*) AS BIGINT) FROM supplier")
def _(spark, sf_dir):
    create_functions(spark, _ingested(spark, sf_dir))
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS type, count(*) AS n FROM read_smf('{t}')" for t in ("smf70", "smf113", "smf1154", "raw")
        )
    )


@_query("s11_partition_write", f"{_WITH_STORED} SELECT customer, path_system_id, year, month, {_SHOWN} "
        "FROM stored")
def _(spark, sf_dir):
    rows = D.read_table(spark, _stored(spark, sf_dir), "smf30")
    return rows.select("customer", "path_system_id", "year", "month", *_SHOWN_COLUMNS)


@_query("s13_append_roundtrip", f"{_WITH_STORED} SELECT {_SHOWN}, 'R1' AS run_id FROM stored "
        f"UNION ALL SELECT {_SHOWN}, 'R2' FROM stored")
def _(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    rows = D.with_partitions(_order_rows(spark, sf_dir), F.lit("ALL")).drop("owner")
    for run in ("R1", "R2", "R2"):  # the last write stands for a run repeated after a failure
        D.write_table(D.clustered(rows.withColumn("run_id", F.lit(run)), "customer"), f"{root}/smf30")
    return D.read_table(spark, root, "smf30").select(*_SHOWN_COLUMNS, "run_id")


@_query("s13_compacted", f"{_WITH_STORED} SELECT {_SHOWN}, 'R' || excp_count % 4 AS run_id FROM stored")
def _(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    rows = D.with_partitions(_order_rows(spark, sf_dir), F.lit("ALL")).drop("owner")
    rows = rows.withColumn("run_id", F.concat(F.lit("R"), F.col("excp_count") % 4))
    # The last run comes after the first compaction, which a second one then merges again.
    for runs in (("R0", "R1", "R2"), ("R3",)):
        D.write_table(D.clustered(rows.where(F.col("run_id").isin(*runs)), "year", "month"), f"{root}/smf30")
        ended = spark.createDataFrame([(None, r, r, 0, r) for r in runs], D.FILES_SCHEMA)
        ended.write.mode("append").parquet(f"{root}/{D.FILES}")
        compaction.compact(spark, root, "smf30", compaction.months_present(spark, root, "smf30", before=(1998, 1)))
    compaction.vacuum(spark, root, "smf30", retention=0)
    return D.read_table(spark, root, "smf30").select(*_SHOWN_COLUMNS, "run_id")


@_query("s14_lineage", "SELECT CAST(event_id AS BIGINT) AS excp_count, true AS has_file, true AS has_hash, "
        "true AS one_run, CAST(1 AS BIGINT) AS same_place FROM events")
def _(spark, sf_dir):
    rows = D.read_type(spark, _ingested(spark, sf_dir), "smf30")
    place = F.count(F.lit(1)).over(Window.partitionBy("source_file", "record_seq", "entry_seq"))
    return rows.select(
        "excp_count",
        F.col("source_file").rlike("[.]bin$").alias("has_file"),
        F.col("file_hash").rlike("^[0-9A-F]{32}$").alias("has_hash"),
        (F.col("run_id").isNotNull() & F.col("ingest_ts").isNotNull()).alias("one_run"),
        place.alias("same_place"),
    )


@_query("s15_seed", "SELECT DISTINCT concat(p_brand, '*') AS job_pattern, 'App ' || p_brand AS application, "
        "'Group \"' || right(p_brand, 1) || '\", x' AS app_group FROM part")
def _(spark, sf_dir):
    path = scratch_dir(spark, "seed")
    T.source_table(spark, sf_dir, "part").selectExpr(
        "concat(p_brand, '*') as job_pattern", "concat('App ', p_brand) as application",
        "concat('Group \"', right(p_brand, 1), '\", x') as app_group",
    ).distinct().write.option("header", True).csv(path)
    return read_seed(spark, path)


@_query("s16_csv_export", f"""{_MARTS_SQL}
SELECT customer, application, app_group, round(sum(cpu_sec), 2) AS cpu_sec,
       round(sum(ziip_sec), 2) AS ziip_sec, CAST(sum(step_runs) AS BIGINT) AS step_runs
FROM agg GROUP BY ALL""")
def _(spark, sf_dir):
    import datetime as dt

    out = scratch_dir(spark, "csv")
    R.export_csv(_marts(spark, sf_dir), out, only=["consumption_by_application"], day=dt.date(2026, 1, 2))
    return spark.read.schema(
        "customer string, application string, app_group string, cpu_sec double, ziip_sec double, "
        "step_runs bigint"
    ).option("header", True).csv(f"{out}/consumption_by_application-20260102")


@_query("s17_materialise", f"{_MARTS_SQL} SELECT * FROM agg")
def _(spark, sf_dir):
    target = scratch_dir(spark, "marts")
    for _ in range(2):  # a rebuild gives the same tables
        built = M.build_marts(spark, acct(spark, sf_dir, narrow=True), seed(spark), target)
    # the stored table also has the columns of its folders
    return built["agg_consumption_daily"].drop("year", "month")


@_query("s17_refresh", f"{_MARTS_SQL} SELECT * FROM agg".replace("n.n_name AS customer", "'ACME' AS customer"))
def _(spark, sf_dir):
    root, target = scratch_dir(spark, "lake"), scratch_dir(spark, "marts")
    rows = acct(spark, sf_dir).withColumns({
        "customer": F.lit("ACME"), "path_system_id": F.lit("ALL"), "year": F.date_format("smf_date", "yyyy"),
        "month": F.date_format("smf_date", "MM"), "file_hash": F.col("source_file"),
    })
    # Some of the files, then the others and one of the first once more.
    for run, files in (("R1", "0 1 2 3 4 5"), ("R2", "6 7 8 9 3")):
        names = [f"batch-{n}" for n in files.split()]
        chosen = rows.where(F.col("source_file").isin(names)).withColumn("run_id", F.lit(run))
        D.write_table(D.clustered(chosen, "year", "month"), f"{root}/smf30")
        spark.createDataFrame([(None, n, n, 0, run) for n in names], D.FILES_SCHEMA).write.mode("append").parquet(f"{root}/{D.FILES}")
        refresh.refresh_marts(spark, root, seed(spark), target)
    return refresh.read_refreshed(spark, target)["agg_consumption_daily"].drop("year", "month")


@_query("s18_adhoc_sql", f"{_WITH_ACCT} SELECT system_id, year, CAST(count(*) AS BIGINT) AS n, "
        "round(sum(elapsed_sec), 1) AS elapsed FROM acct WHERE job_name LIKE 'Brand#1%' GROUP BY ALL")
def _(spark, sf_dir):
    acct(spark, sf_dir).createOrReplaceTempView("acct_adhoc")
    return spark.sql(
        "SELECT system_id, year, count(*) AS n, round(sum(elapsed_sec), 1) AS elapsed FROM acct_adhoc "
        "WHERE job_name LIKE 'Brand#1%' GROUP BY ALL"
    )


# -- incremental ingest --------------------------------------------------------------------------


@_query("x01_incremental", "SELECT upper(event_type) AS job_name, CAST(event_id AS BIGINT) AS excp_count, "
        "CAST(round(value * 100) AS BIGINT) / 100.0 AS cpu_sec FROM events")
def _(spark, sf_dir):
    log, root = _routing_log(spark, sf_dir), scratch_dir(spark, "lake")
    for _ in range(2):  # the second call finds nothing new
        ingest_stream(spark, log, root, f"{root}-state").awaitTermination()
    return D.read_type(spark, root, "smf30").select("job_name", "excp_count", "cpu_sec")


@_query("x02_latest_copies", "SELECT CAST(event_id AS BIGINT) AS excp_count, true AS latest FROM events")
def _(spark, sf_dir):
    log, root = T.table_log(spark, sf_dir, "smf30"), scratch_dir(spark, "lake")
    for run in ("R1", "R2"):
        ingest(spark, log, root, run_id=run)
    rows = latest_copies(D.read_type(spark, root, "smf30"), D.read_files(spark, root))
    return rows.select("excp_count", (F.col("run_id") == "R2").alias("latest"))


@_query("k04_reconciliation", "SELECT disposition, CAST(sum(n) AS BIGINT) AS records FROM ("
        "SELECT 'typed' AS disposition, count(*) AS n FROM events UNION ALL "
        "SELECT 'typed', 2 * count(*) FROM part UNION ALL SELECT 'typed', count(*) FROM orders UNION ALL "
        "SELECT 'header_only', 3 * count(*) FROM supplier UNION ALL SELECT 'raw', count(*) FROM supplier"
        ") t GROUP BY disposition")
def _(spark, sf_dir):
    audit = D.read_audit(spark, _ingested(spark, sf_dir))
    return audit.groupBy("disposition").agg(F.sum("records").alias("records"))
