"""Times the headline work at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from acctlake.fixtures import trial as T  # noqa: E402
from acctlake.fixtures.accounts import acct, seed  # noqa: E402
from acctlake.fixtures.catalog import QUERIES  # noqa: E402
from acctlake.operators import layouts as L  # noqa: E402
from acctlake.operators.decode import decode_table  # noqa: E402
from acctlake.plans import marts as M  # noqa: E402
from acctlake.plans.ingest import ingest  # noqa: E402
from acctlake.session import build_session, scratch_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

#: Queries timed as they are registered. Binary logs are written beforehand and not timed.
REGISTERED = (
    "q0", "q1", "q2", "q3", "q4",
    "m2_dim_application", "m3_fct_job_consumption", "m4_agg_consumption_daily", "m5_rpt_jobs_by_date",
    "r1_jobs_by_date", "r2_consumption_daily", "r3_top_consumers", "r4_consumption_by_application",
    "r5_metric_by_dimension", "r6_drill_step",
    "j01_like_join", "w02_lag",
    "t01_smf30", "t02_smf70_1", "t05_smf72_3", "t07_smf74_1", "t14_smf74_7", "t26_smf1154_1",
)
LOGS = ("smf30", "smf70-1", "smf72-3", "smf74-1", "smf74-7", "smf1154-1")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def large_records(spark, entries: int, total: int = 440_000):
    """Routed device records with ``entries`` entries each; all sizes hold equally many entries."""
    layout = L.BY_TABLE["smf74-1"]
    width = max(f.offset + (f.width or 8) for f in layout.fields if f.section == "row")
    at = layout.directory + 12 * (max(*layout.sections, layout.rows) + 1)
    directory = {s: F.lit("00" * 12) for s in range(max(*layout.sections, layout.rows) + 1)}
    directory[layout.rows] = F.lit(f"{at:08X}{width:08X}{entries:08X}")
    one = F.lpad(F.hex("id"), 2 * width, "0")
    body = F.unhex(F.concat(F.lit("00" * layout.directory), *directory.values(), F.repeat(one, entries)))
    names = [c for c in L.COMMON_COLUMNS if c != "ingest_ts"]
    rows = spark.range(total // entries).select(
        *[F.lit(None).cast(L.COMMON_COLUMNS[c]).alias(c) for c in names],
        F.col("id").alias("record_seq"), F.lit("x").alias("file_hash"), body.alias("body"),
    )
    path = scratch_dir(spark, f"records-{entries}")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    for table in LOGS:
        T.table_log(spark, SF_DIR, table)
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        # The first run compiles the plan's code; the second one is reported.
        for _ in range(2):
            began = time.perf_counter()
            work()
            seconds[name] = round(time.perf_counter() - began, 3)

    for name in REGISTERED:
        timed(name, lambda: run(QUERIES[name](spark, SF_DIR)))
    timed("build_marts", lambda: M.build_marts(
        spark, acct(spark, SF_DIR), seed(spark), scratch_dir(spark, "marts")))
    for entries in (10, 400):
        records = large_records(spark, entries)
        timed(f"decode_{entries}_entries_a_record", lambda: run(decode_table(records, "smf74-1")))
    logs = [T.table_log(spark, SF_DIR, t) for t in ("smf30", "smf72-3")]
    timed("ingest", lambda: ingest(spark, logs, scratch_dir(spark, "lake")))
    print(json.dumps({
        "metric": "total seconds, headline queries, second of two runs each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
