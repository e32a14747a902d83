"""The ingest job: binary logs to the partitioned dataset, with an account of every record.

One pass over the input. Records are split, their headers decoded, and one shuffle brings the
records of a table, system and month together in a staging table on shared storage; from there
each table present is decoded and written without another shuffle. Losing an executor costs the
tasks it ran: staging is a written table, not cached blocks.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from acctlake.operators.decode import decode_table
from acctlake.operators.route import MALFORMED, ROUTE_KEYS, disposition, route, tables_of
from acctlake.session import drop_scratch, scratch_dir
from acctlake.sources import dataset as D
from acctlake.sources.rdw import PREFIX, list_logs, split_files

DEFAULT_CUSTOMER = "INTERNAL"
#: Tables written at the same time; each is its own Spark job and small ones would idle the rest.
WRITERS = 6


def new_run_id(now: dt.datetime) -> str:
    return f"{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def stage(frames: DataFrame, path: str) -> DataFrame:
    """Route framed records into a staging table, one folder per publishing job; returns it.

    Header-only tables share a folder: their names come from the data, and damaged records could
    name any number of them.
    """
    typed = [key for key in ROUTE_KEYS if disposition(key) != "header_only"]
    name = F.col("table_name")
    routed = (
        route(frames)
        .withColumn("stage_key", F.when(name.isin(*typed), name).otherwise(F.lit(D.HEADER_ONLY)))
        .withColumn("_month", F.date_format("smf_date", "yyyyMM"))
    )
    D.clustered(routed, "stage_key", "table_name", "system_id", "_month").write.mode(
        "overwrite"
    ).option("compression", "zstd").partitionBy("stage_key").parquet(path)
    return frames.sparkSession.read.schema(routed.schema).parquet(path)


def account(staged: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Records per file and table, stored at ``path``; raises if any record is missing.

    The check does not trust task counters, which repeat when tasks do. A file is complete if its records and
    their prefixes fill it from the first byte to the last, or to the frame that ended it, and if their
    sequence numbers are 0 to n - 1: n of them with that smallest, largest and sum.
    """
    spark = staged.sparkSession
    staged.groupBy("source_file", "stage_key", "table_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("record_seq").alias("first_seq"), F.max("record_seq").alias("last_seq"),
        F.sum("record_seq").cast("decimal(38,0)").alias("seq_sum"),
        F.sum(F.length("body") + F.lit(PREFIX)).alias("bytes"),
        F.max(F.when(F.col("body").isNull(), F.col("byte_offset"))).alias("broken_at"),
        F.max("file_hash").alias("file_hash"),
    ).write.mode("overwrite").parquet(path)
    per_file = spark.read.schema(
        "source_file string, stage_key string, table_name string, records bigint, first_seq bigint, last_seq bigint, "
        "seq_sum decimal(38,0), bytes bigint, broken_at bigint, file_hash string"
    ).parquet(path)
    found = per_file.groupBy("source_file").agg(
        F.sum("records").alias("records"), F.min("first_seq").alias("first"), F.max("last_seq").alias("last"),
        F.sum("seq_sum").alias("seq_sum"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("broken_at").alias("broken_at"),
    )
    n = F.col("records").cast("decimal(18,0)")
    complete = (
        (F.col("first") == 0) & (F.col("last") == F.col("records") - 1)
        & (F.col("seq_sum") * 2 == n * (n - 1))
        & (F.col("bytes") == F.coalesce("broken_at", "length"))
    )
    wrong = (
        files.where("length > 0")
        .select("source_file", "length")
        .distinct()
        .join(found, "source_file", "left")
        .where(~F.coalesce(complete, F.lit(False)))
        .select(F.count(F.lit(1)).alias("n"), F.min("source_file").alias("example"))
        .first()
    )
    if wrong["n"]:
        raise RuntimeError(f"records are missing from {wrong['n']} files, such as {wrong['example']}")
    return per_file


def ingest(spark: SparkSession, paths: str | list[str], root: str,
           customer: str = DEFAULT_CUSTOMER, run_id: str | None = None,
           ingest_ts: dt.datetime | None = None, glob: str | None = None) -> DataFrame:
    """Read all logs under ``paths`` into the dataset at ``root``; returns the audit (see below)."""
    return ingest_files(list_logs(spark, paths, glob), root, customer, run_id, ingest_ts)


def ingest_files(files: DataFrame, root: str, customer: str = DEFAULT_CUSTOMER,
                 run_id: str | None = None, ingest_ts: dt.datetime | None = None) -> DataFrame:
    """Ingest listed files (``source_file, length``).

    The audit has one row per table: how many records were read for it and how many rows they
    gave. It is also kept in the dataset. Every record read is typed, header-only, raw or
    malformed; the job fails if one is missing.
    """
    spark = files.sparkSession
    now = ingest_ts or dt.datetime.now(dt.timezone.utc)
    run = run_id or new_run_id(now)
    scratch = scratch_dir(spark, "ingest")
    try:
        staged = stage(split_files(files), f"{scratch}/staged")
        per_file = account(staged, files, f"{scratch}/files")
        # One row per publishing job: as many as there are layouts, at most.
        counts = {
            r["stage_key"]: r["n"]
            for r in per_file.groupBy("stage_key").agg(F.sum("records").alias("n")).collect()
        }
        instant = F.lit(now)
        owner = F.lit(customer)

        def publish(key: str) -> list[dict]:
            records = staged.where(F.col("stage_key") == key)
            written = []
            for table in tables_of(key):
                rows = Observation(f"{table}-{run}")
                decoded = decode_table(records, table, instant, run)
                D.write_table(
                    D.with_partitions(decoded, owner).observe(rows, F.count(F.lit(1)).alias("rows")),
                    f"{root}/{table}",
                )
                written.append({"table_name": table, "rows": rows.get["rows"]})
            return written

        def publish_header_only() -> list[dict]:
            records = staged.where(F.col("stage_key") == D.HEADER_ONLY)
            decoded = decode_table(records, "header", instant, run, keep=("table_name",))
            D.write_table(D.with_partitions(decoded, owner), f"{root}/{D.HEADER_ONLY}", by_table=True)
            return []

        def publish_malformed() -> list[dict]:
            # Kept as found: where the frame is, what was wrong, and its bytes if it had any.
            bad = staged.where(F.col("stage_key") == MALFORMED).select(
                "source_file", "record_seq", "byte_offset", "error", "body", "file_hash",
                instant.alias("ingest_ts"), F.lit(run).alias("run_id"),
            )
            _replace_run(bad, f"{root}/{D.MALFORMED}")
            return [{"table_name": MALFORMED, "rows": counts[MALFORMED]}]

        special = {D.HEADER_ONLY: publish_header_only, MALFORMED: publish_malformed}
        jobs = [special.get(key, lambda key=key: publish(key)) for key in counts]
        with ThreadPoolExecutor(WRITERS) as pool:
            rows = {r["table_name"]: r["rows"] for job in pool.map(lambda j: j(), jobs) for r in job}

        audit = [
            # the second table of a shared record must not count it twice
            (now, table, disposition(key), n if table == tables_of(key)[0] else 0, rows[table], run)
            for key, n in counts.items()
            if key != D.HEADER_ONLY
            for table in tables_of(key)
        ]
        headers = per_file.where(F.col("stage_key") == D.HEADER_ONLY).groupBy("table_name").agg(
            F.sum("records").alias("records")
        )
        result = spark.createDataFrame(audit, D.AUDIT_SCHEMA).unionByName(
            headers.select(
                instant.alias("ingest_ts"), "table_name", F.lit(D.HEADER_ONLY).alias("disposition"),
                "records", F.col("records").alias("rows"), F.lit(run).alias("run_id"),
            )
        )
        if counts:
            _replace_run(result, f"{root}/{D.AUDIT}")
            # Last: a file counts as ingested when all its tables are there.
            inputs = per_file.groupBy("source_file").agg(
                F.max("file_hash").alias("file_hash"), F.sum("records").alias("records")
            )
            _replace_run(
                inputs.select(
                    instant.alias("ingest_ts"), "source_file", "file_hash", "records", F.lit(run).alias("run_id")
                ),
                f"{root}/{D.FILES}",
            )
        return D.read_audit(spark, root).where(F.col("run_id") == run) if counts else spark.createDataFrame(
            [], D.AUDIT_SCHEMA
        )
    finally:
        drop_scratch(spark, scratch)


def _replace_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd"
    ).partitionBy("run_id").parquet(path)
