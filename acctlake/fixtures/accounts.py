"""The given tables seen as job accounting rows, and the mapping used with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Valid in Spark and DuckDB alike. Blank jobs, blank programs and rows without consumption are
#: in it on purpose.
ACCT_SQL = """
SELECT n.n_name AS customer,
       CASE WHEN l.l_linenumber = 7 THEN '' ELSE p.p_brand END AS job_name,
       concat('STEP', l.l_linenumber) AS step_name,
       concat('JOB', l.l_orderkey) AS job_id,
       CASE WHEN l.l_returnflag = 'N' THEN '' ELSE p.p_type END AS program_name,
       l.l_shipdate AS smf_timestamp,
       CAST(l.l_shipdate AS DATE) AS smf_date,
       concat('SYS', l.l_suppkey % 4) AS system_id,
       'JES2' AS subsystem_id,
       CASE WHEN l.l_linenumber = 6 THEN CAST(0 AS DOUBLE) ELSE l.l_quantity + CAST(l.l_linenumber AS DOUBLE) END AS cpu_sec,
       CASE WHEN l.l_linenumber = 6 THEN CAST(0 AS DOUBLE) ELSE l.l_quantity END AS tcb_sec,
       CASE WHEN l.l_linenumber = 6 THEN CAST(0 AS DOUBLE) ELSE CAST(l.l_linenumber AS DOUBLE) END AS srb_sec,
       l.l_tax AS ziip_sec,
       l.l_extendedprice AS elapsed_sec,
       CAST(l.l_suppkey AS BIGINT) AS excp_count,
       CAST(year(l.l_shipdate) AS INT) AS year,
       CAST(month(l.l_shipdate) AS INT) AS month,
       concat('batch-', l.l_orderkey % 10) AS source_file
FROM lineitem l
JOIN part p     ON l.l_partkey = p.p_partkey
JOIN orders o   ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n   ON c.c_nationkey = n.n_nationkey
"""

#: The joins of ``ACCT_SQL`` in another order, for the same rows: orders get their nation first, and names come last. So the rows of
#: lineitem, by far the most, are shuffled by order and by part only, and without names.
JOINS_SQL = """
FROM lineitem l
JOIN (SELECT o.o_orderkey, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) a
                ON l.l_orderkey = a.o_orderkey
JOIN part p     ON l.l_partkey = p.p_partkey
JOIN nation n   ON a.c_nationkey = n.n_nationkey
"""

#: job_pattern, application, app_group. The comments say what each is there for.
SEED_ROWS = (
    ("*#1*", "Billing", "FinanceCo"),  # short pattern
    ("Brand#12", "Payroll", "FinanceCo"),  # exact name beats it
    ("*#2*", "Database", "Platform"),
    ("Brand#25", "QA", "Internal"),
    ("*rand#20", "Reporting", "Internal"),  # as long as the next one; the smaller text wins
    ("Brand#20", "Ledger", "FinanceCo"),
    ("*#3", "Maintenance", "Platform"),  # end of the name only
)

TABLES = ("lineitem", "part", "orders", "customer", "nation")


def acct(spark: SparkSession, sf_dir: str, narrow: bool = False) -> DataFrame:
    """The rows of ``ACCT_SQL``; ``narrow`` joins in the order of ``JOINS_SQL``. Sums of doubles depend on the order of rows in their last digits."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    text = ACCT_SQL.partition("FROM lineitem")[0] + JOINS_SQL if narrow else ACCT_SQL
    for name in TABLES:
        text = text.replace(f" {name} ", f" {{{name}}} ")
    return spark.sql(text, **tables)


def seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(SEED_ROWS), "job_pattern string, application string, app_group string"
    )


def seed_sql() -> str:
    """The mapping as a DuckDB table expression."""
    rows = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in SEED_ROWS)
    return f"(VALUES {rows}) AS m(job_pattern, application, app_group)"
