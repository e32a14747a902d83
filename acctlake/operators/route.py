"""Which table a record belongs to, and the account of where every record went."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlake.operators import layouts as L
from acctlake.operators.header import decode_header

MALFORMED = "malformed"

#: Route keys known beforehand; every other key is a header-only table.
ROUTE_KEYS = (
    *(layout.table for layout in L.LAYOUTS if not layout.table.startswith("smf74-2")),
    "smf74-2", "raw", MALFORMED,
)


def table_name(record_type: Column, subtype: Column) -> Column:
    """Route key of a record.

    A handful of comparisons against fixed codes, so it is an expression, not a join. Type 74
    subtype 2 has the single key ``smf74-2``; its two tables are decoded from the same records.
    """
    suffix = F.when(subtype > 0, F.concat(F.lit("-"), subtype.cast("string"))).otherwise(F.lit(""))
    numbered = F.concat(F.lit("smf"), record_type.cast("string"), suffix)
    whole = [x.record_type for x in L.LAYOUTS if not x.subtypes]
    return (
        F.when(record_type.isin(*whole), F.concat(F.lit("smf"), record_type.cast("string")))
        .when((record_type == 113) & subtype.isin(1, 2), F.lit("smf113"))
        # its subtype 0 is header-only and must not be taken for the shared counter table
        .when((record_type == 113) & (subtype == 0), F.lit("smf113-0"))
        .when(record_type.isin(*L.HEADER_ONLY_TYPES), numbered)
        .otherwise(F.lit("raw"))
    )


def tables_of(key: str) -> list[str]:
    """Tables decoded from the records of one route key."""
    return ["smf74-2p", "smf74-2m"] if key == "smf74-2" else [key]


def disposition(key: str) -> str:
    if key in ("raw", MALFORMED):
        return key
    return "typed" if tables_of(key)[0] in L.BY_TABLE else "header_only"


def route(frames: DataFrame) -> DataFrame:
    """Header columns plus ``table_name`` for every framed record, damaged ones included."""
    decoded = decode_header(frames)
    key = table_name(F.col("record_type"), F.col("subtype"))
    routed = decoded.withColumn(
        "table_name", F.when(F.col("error").isNotNull(), F.lit(MALFORMED)).otherwise(key)
    )
    return routed.withColumn(
        "subtype", F.when(F.col("table_name") == "raw", F.lit(0)).otherwise(F.col("subtype"))
    )


def records_of(routed: DataFrame, table: str) -> DataFrame:
    """The records a table is decoded from."""
    key = "smf74-2" if table in ("smf74-2p", "smf74-2m") else table
    return routed.where(F.col("table_name") == key)


def type_counts(routed: DataFrame) -> DataFrame:
    """Records per type, subtype and table."""
    return routed.groupBy("record_type", "subtype", "table_name").agg(
        F.count(F.lit(1)).alias("records")
    )
