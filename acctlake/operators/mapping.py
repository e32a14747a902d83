"""Jobs to business applications through user-edited patterns; the most specific pattern wins.

A pattern can match anywhere in a name, so the plain form of this join compares every job with
every pattern. Here both sides get equality keys instead: a pattern's key is its longest stretch of
ordinary characters, a job's keys are the substrings of its name that are as long as some pattern key.
Each different name is matched once, however many rows have it. Whatever a pattern matches contains its key, so the equality join finds every candidate, and LIKE
decides. Spark then chooses the join by the measured size of the pattern table; nothing is
broadcast by force and no side is multiplied by the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctlake.functions.text import glob_match

# Fixed values of the dimension.
UNMAPPED, UNASSIGNED = "(unmapped)", "Unassigned"


def pattern_key(pattern: Column) -> Column:
    """Longest run of characters in a pattern that are not wildcards; '' if there is none."""
    return F.aggregate(
        F.split(pattern, "[*%_]"),
        F.lit(""),
        lambda best, run: F.when(F.length(run) > F.length(best), run).otherwise(best),
    )


def name_keys(name: Column, sizes: Column) -> Column:
    """The distinct substrings of a name that have one of the given sizes."""
    pieces = F.flatten(
        F.transform(
            F.filter(sizes, lambda size: size <= F.length(name)),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.greatest(F.length(name) - size, F.lit(0)) + F.lit(1)),
                lambda at: F.substring(name, at, size),
            ),
        )
    )
    return F.array_distinct(pieces)


def _keyed_patterns(patterns: DataFrame) -> tuple[DataFrame, Column]:
    """The patterns with their key, and the sizes that keys have: as many as the longest pattern has letters, at most."""
    keyed = patterns.withColumn("_key", pattern_key(F.col("job_pattern")))
    return keyed, keyed.agg(F.collect_set(F.length("_key"))).scalar()


def pattern_matches(names: DataFrame, patterns: DataFrame, name: str = "job_name") -> DataFrame:
    """Every (row, pattern) pair whose name matches: the inner LIKE join of the two sides."""
    keyed, sizes = _keyed_patterns(patterns)
    different = names.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    matched = (
        different.withColumn("_sizes", sizes)
        .withColumn("_key", F.explode(name_keys(F.col("_name"), F.col("_sizes"))))
        .join(keyed, "_key")
        .where(glob_match(F.col("_name"), F.col("job_pattern")))
        .drop("_key", "_sizes")
    )
    return names.join(matched, F.col(name) == F.col("_name")).drop("_name")


def most_specific(matches: DataFrame, *keys: str) -> DataFrame:
    """Per key the match with the longest pattern; equal lengths are decided by the smaller text."""
    order = Window.partitionBy(*keys).orderBy(F.length("job_pattern").desc(), "job_pattern")
    return matches.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def best_match(names: DataFrame, patterns: DataFrame, name: str = "job_name") -> DataFrame:
    """The rows of ``names``, which must be distinct, with ``application, app_group`` of the most specific pattern; NULL
    where none matches.

    Same rule as :func:`most_specific`, as an aggregate: it combines before the shuffle, so a name that matches very
    many patterns does not meet them all in one task. ``names`` is read once.
    """
    keyed, sizes = _keyed_patterns(patterns)
    rank = F.struct((-F.length("job_pattern")).alias("l"), F.col("job_pattern").alias("p"))
    matches = F.col("job_pattern").isNotNull() & glob_match(F.col(name), F.col("job_pattern"))
    chosen = F.min_by(F.struct("application", "app_group"), F.when(matches, rank))
    return (
        names.withColumn("_sizes", sizes)
        .withColumn("_key", F.explode_outer(name_keys(F.col(name), F.col("_sizes"))))
        .join(keyed, "_key", "left")
        .groupBy(*names.columns)
        .agg(chosen.alias("_m"))
        .select(*names.columns, "_m.application", "_m.app_group")
    )


def dim_application(staged: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row per (customer, job_name) with its application; nothing is lost when none matches."""
    jobs = staged.select("customer", "job_name").distinct()
    return best_match(jobs, patterns).select(
        F.concat("customer", F.lit("|"), "job_name").alias("app_key"),
        "customer",
        "job_name",
        F.coalesce("application", F.lit(UNMAPPED)).alias("application"),
        F.coalesce("app_group", F.lit(UNASSIGNED)).alias("app_group"),
    )
