"""Incremental ingest of newly arrived logs, and reading past repeated batches.

Late rows and files that straddle midnight need no watermark: rows are stored under the date they
carry, and publishing only adds files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from acctlake.plans.ingest import DEFAULT_CUSTOMER, ingest_files

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, folder: str, glob: str | None = None,
              files_per_batch: int | None = None) -> DataFrame:
    """Stream of ``source_file, length``; each file appears once. Contents are not read here."""
    reader: DataStreamReader = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(F.col("path").alias("source_file"), "length")


def _publisher(root: str, customer: str) -> Callable[[DataFrame, int], None]:
    def publish(batch: DataFrame, batch_id: int) -> None:
        # The query id lives in the checkpoint: a batch that is repeated after a failure has the
        # same run id and replaces its own files, and another stream can never have it.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ingest_files(batch, root, customer, run_id=f"{query}-{batch_id:010d}")

    return publish


def ingest_stream(spark: SparkSession, folder: str, root: str, checkpoint: str,
                  customer: str = DEFAULT_CUSTOMER, glob: str | None = None,
                  files_per_batch: int | None = None, every: str | None = None) -> StreamingQuery:
    """Ingest what has arrived since the last call, then stop; with ``every``, keep going.

    ``every`` is a trigger interval such as ``"15 minutes"``.
    """
    writer = (
        new_files(spark, folder, glob, files_per_batch)
        .writeStream.foreachBatch(_publisher(root, customer))
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def latest_copies(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of each input file once, though the file was ingested several times.

    A file is recognised by its content, so a renamed copy counts as the same; the latest ingest is kept. ``files`` is the
    account of input files (:func:`acctlake.sources.dataset.read_files`): one row per file decides, and the rows themselves are only
    filtered, never grouped. Rows of a run that did not end are not in the account and stay out.
    """
    kept = files.groupBy("file_hash").agg(
        F.max(F.struct("ingest_ts", "run_id", "source_file")).alias("kept")
    ).select("file_hash", F.col("kept.run_id").alias("run_id"),
             F.col("kept.source_file").alias("source_file"))
    return rows.join(kept, ["file_hash", "run_id", "source_file"], "left_semi")
