"""The user-edited mapping of job patterns to applications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acctlake.operators.checks import assert_checks

SEED_SCHEMA = "job_pattern string, application string, app_group string"


def read_seed(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Typed mapping rows from a CSV file with a header; patterns must be filled and unique."""
    seed = (
        spark.read.schema(SEED_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if check:
        assert_checks({"map_job_application": seed})
    return seed
