"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from acctlake.sources.files import remove_tree

#: Settings every job of this package assumes; pass them to ``spark-submit`` or the builder.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # system "0001" and customer "2024" must stay text when read back from directory names
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Decoding a table is one wide projection. Java only compiles methods up to this size; beyond it
    # Spark then generates many small ones instead of one that stays interpreted (3 times slower).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Batches to Python are bounded in bytes as well as in rows: records, pages and tables of ranges are long.
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # Plans of many columns are built call by call; recording the Python line of each call doubles it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "acctlake", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a session that runs on one machine may leave it unset and gets a local one: on a cluster
    each executor would write to its own disk.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        configured = tempfile.mkdtemp(prefix="acctlake-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder made by :func:`scratch_dir`; anything else is refused."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"{path} is not a scratch folder")
    remove_tree(path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that runs inside are removed when it ends; Spark else keeps them until the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
