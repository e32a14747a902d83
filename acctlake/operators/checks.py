"""Data-quality checks that belong to every build of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Which columns must be filled, and which must be unique, per model.
NOT_NULL = {
    "stg_smf30": ("smf_date", "system_id"),
    "dim_application": ("job_name", "application", "app_key"),
    "fct_job_consumption": ("application", "cpu_sec"),
    "agg_consumption_daily": ("cpu_sec",),
    "map_job_application": ("job_pattern", "application"),
}
UNIQUE = {"dim_application": ("app_key",), "map_job_application": ("job_pattern",)}


def check_model(model: str, df: DataFrame) -> DataFrame:
    """``model, check, column_name, failures`` of all checks of a model: one pass over it.

    ``not_null`` counts rows, ``unique`` counts values that occur more than once. Rows of equal values are added up
    before the shuffle.
    """
    filled, (key, *more) = NOT_NULL.get(model, ()), UNIQUE.get(model, (None,))
    if more:
        raise ValueError(f"{model}: only one column can be checked to be unique")
    nulls = {f"{c}|not_null": F.count_if(F.col(c).isNull()) for c in filled}
    if key is None:
        counted = df.agg(*[v.alias(k) for k, v in nulls.items()])
    else:
        by_value = df.groupBy(F.col(key).alias("_value")).agg(
            F.count(F.lit(1)).alias("_rows"), *[v.alias(k) for k, v in nulls.items()]
        )
        repeated = F.count_if((F.col("_rows") > 1) & F.col("_value").isNotNull())
        counted = by_value.agg(
            *[F.coalesce(F.sum(f"`{k}`"), F.lit(0)).alias(k) for k in nulls], repeated.alias(f"{key}|unique")
        )
    names = counted.columns
    return counted.unpivot([], [f"`{n}`" for n in names], "_name", "failures").select(
        F.lit(model).alias("model"),
        F.split_part("_name", F.lit("|"), F.lit(2)).alias("check"),
        F.split_part("_name", F.lit("|"), F.lit(1)).alias("column_name"),
        F.col("failures").cast("long").alias("failures"),
    )


def run_checks(models: dict[str, DataFrame]) -> DataFrame:
    """All checks of the given models as one table."""
    parts = [check_model(m, df) for m, df in models.items() if m in NOT_NULL or m in UNIQUE]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def assert_checks(models: dict[str, DataFrame]) -> None:
    """Raise if any check failed. Only the failed checks (a row each) reach the driver."""
    failed = run_checks(models).where("failures > 0").collect()
    if failed:
        listed = ", ".join(f"{r.model}.{r.column_name} {r.check}: {r.failures}" for r in failed)
        raise ValueError(f"data checks failed: {listed}")
