"""Rounding as the reports define it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, places: int) -> Column:
    """Round to ``places`` decimals, halves away from zero, judged on the scaled binary value.

    Spark's own ``round`` judges the shortest decimal text of a double instead, and so differs for
    sums that sit next to a half.
    """
    scale = F.lit(float(10**places))
    return F.round(value * scale) / scale


def rounded_sum(column: str, places: int) -> Column:
    return round_to(F.sum(column), places)
