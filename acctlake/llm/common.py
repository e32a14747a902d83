"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import itertools
import math
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.session import drop_scratch, scratch_dir

#: Word separators of every operator: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a task works on at a time.
PIECE = 1 << 20


def ship(module_name: str) -> None:
    """Send a module's functions to the tasks by value, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


#: Folders staged in each open scope, innermost last.
_SCOPES: list[list[str]] = []
#: Settings of a scope: shuffle files go after each job, and batches of texts are small on both sides of the way to Python.
IN_SCOPE = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is removed at the end, except what is staged with ``keep``; shuffle files go after each job.

    Nothing that is used later may depend on the rest, so all work has to be done inside.
    """
    before = {key: spark.conf.get(key, None) for key in IN_SCOPE}
    for key, value in IN_SCOPE.items():
        spark.conf.set(key, value)
    _SCOPES.append([])
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        for path in _SCOPES.pop():
            drop_scratch(spark, path)


def stage(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared scratch and read it back.

    Cuts the lineage in a place that every executor can read again after a loss. With ``keep`` the folder outlives the scope that
    is open; it then belongs to the one around it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    owners = _SCOPES[:-1] if keep else _SCOPES
    if owners:
        owners[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_row(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the place of each row in its Parquet files as the struct ``name``: the same in every scan, equal rows differ.

    Rows that do not come straight from Parquet files are staged first.
    """
    try:
        meta = df.metadataColumn("_metadata")
        return df.withColumn(name, F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("at")))
    except AnalysisException:
        return with_row(stage(df, "numbered", keep=True), name)


def with_key(*columns: str) -> Column:
    """128 bits that stand for the values of ``columns``; NULL and empty text differ."""
    parts = [F.col(c) for c in columns]
    nulls = F.concat(*[F.when(p.isNull(), "1").otherwise("0") for p in parts])
    return F.struct(
        F.xxhash64(*parts, nulls).alias("a"),
        F.xxhash64(F.lit(0x5EED), nulls, *reversed(parts)).alias("b"),
    )


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL; one pass, no array of words."""
    gaps = F.regexp_count(text, F.lit(SPACE))
    lead = F.when(text.rlike(r"\A" + SPACE), 1).otherwise(0)
    # A non-empty text has one word more than gaps; a gap at either end separates nothing.
    tail = F.when(text.rlike(SPACE + r"\z"), 1).otherwise(0)
    words = F.when(text.rlike(r"\A[\x20\x09-\x0D]*\z"), 0).otherwise(gaps + 1 - lead - tail)
    return F.coalesce(words, F.lit(0)).cast("long")


def pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """All rows of ``batches``, in order, in runs of about ``PIECE`` bytes of column number ``text``; a text is never cut.

    What a task makes of a batch, and the batches that it sends back, then stay small however many rows arrive at once.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(sizes) - sizes) // PIECE
        for start, end in itertools.pairwise([0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]):
            yield batch.slice(start, end - start)


def slices(rows: int, per_slice: int) -> int:
    """A power of two so that ``rows`` fall into parts of about ``per_slice``."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows / per_slice))))


ship(__name__)
