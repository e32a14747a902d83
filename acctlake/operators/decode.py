"""Turn routed records into the rows of one table, driven by its layout.

Headers are built-in column expressions; values of the record and the entries of its row section are read in
:mod:`acctlake.operators.entries`, for a batch of records at a time. The record itself is not handed on, so rows stay
narrow. There is no shuffle from record to row.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlake.functions import binary as B
from acctlake.operators import layouts as L
from acctlake.operators.entries import layout_rows
from acctlake.operators.sections import (
    Section,
    directory_entry,
    directory_position,
    section_column,
)

_HEADER = [name for name in L.COMMON_COLUMNS if name != "ingest_ts"]


def _entry_numbers(count: Column) -> Column:
    """0 .. count-1, and no entries for a count of 0 (``sequence(0, -1)`` would count down)."""
    return F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - F.lit(1))).otherwise(
        F.array().cast("array<bigint>")
    )


def counter_list(body: Column, section: Section) -> Column:
    """A section of unsigned 64-bit counters as one array."""
    return F.transform(
        _entry_numbers(section.count),
        lambda i: B.u64(body, section.entry_start(i), section.entry_end(body, i)),
    )


def sections_of(records: DataFrame, layout: L.Layout) -> DataFrame:
    """Add one struct column per section the layout reads (``_s<k>``; ``_row`` for the row section)."""
    body = F.col("body")

    def entry(index: int) -> Column:
        position = directory_position(layout.directory, index, layout.compact)
        return directory_entry(body, position, layout.compact)

    out = records.select("*", *[entry(k).alias(f"_s{k}") for k in layout.sections])
    if layout.rows is None:
        return out
    if layout.nested_in is None:
        return out.withColumn("_row", entry(layout.rows))
    # The outer section starts with a u32 count, then its own directory; offsets count from the
    # start of the record.
    outer = section_column(f"_s{layout.nested_in}")
    position = outer.offset + F.lit(4 + directory_position(0, layout.rows, False))
    return out.withColumn(
        "_row",
        F.when(outer.count > 0, directory_entry(body, position)).otherwise(
            F.struct(
                F.lit(0).cast("long").alias("offset"),
                F.lit(0).cast("long").alias("length"),
                F.lit(0).cast("long").alias("count"),
            )
        ),
    )


def decode_table(records: DataFrame, table: str, ingest_ts: Column | None = None,
                 run_id: str | None = None, keep: tuple[str, ...] = (),
                 columns: Collection[str] | None = None) -> DataFrame:
    """Rows of one table from records that were routed to it.

    ``records`` carries the header columns, ``record_seq``, ``file_hash`` and ``body``. A table
    without a layout gets the header columns only. ``keep`` names further columns to pass on. With ``columns`` only these are
    read: Spark cannot tell that a column of a batch is not needed later.
    """

    def wanted(name: str) -> bool:
        return columns is None or name in columns

    carried = [name for name in (*_HEADER, "record_seq", "file_hash") if wanted(name)]
    ingest = (F.lit(None) if ingest_ts is None else ingest_ts).cast("timestamp")
    body = F.col("body")
    kept = records.select(*carried, "body", *keep)
    entry_seq = F.lit(0)
    values: dict[str, Column] = {}

    if table == "raw":
        values["body"] = body
    elif table in L.BY_TABLE:
        layout = L.BY_TABLE[table]
        kept = layout_rows(kept, layout, columns)
        if layout.rows is not None:
            entry_seq = F.col("_entry").cast("int")
        values |= {name: F.col(name) for name in layout.interval}
        values |= {f.name: F.col(f.name) for f in layout.fields}

    shown = {
        **{name: F.col(name) for name in _HEADER},
        "ingest_ts": ingest,
        **values,
        "record_seq": F.col("record_seq"),
        "entry_seq": entry_seq,
        "file_hash": F.col("file_hash"),
        "run_id": F.lit(run_id).cast("string"),
    }
    return kept.select(*[value.alias(name) for name, value in shown.items() if wanted(name)], *keep)
