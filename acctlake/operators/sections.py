"""Section directories: where a section starts, how long one entry is, how many there are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from acctlake.functions import binary as B

WIDE, COMPACT = 12, 8


@dataclass(frozen=True)
class Section:
    """Columns describing one section. An absent or out-of-bounds section has ``count`` 0."""

    offset: Column
    length: Column
    count: Column

    def entry_start(self, index) -> Column:
        return self.offset + index * self.length

    def entry_end(self, body: Column, index) -> Column:
        """Fields must end here: inside the entry and inside the record; 0 for an absent section."""
        end = F.least(F.length(body).cast("long"), self.offset + (index + F.lit(1)) * self.length)
        return F.when(self.count > 0, end).otherwise(F.lit(0).cast("long"))


def directory_entry(body: Column, position, compact: bool = False) -> Column:
    """One directory entry as struct(offset, length, count).

    The count is how many of the declared entries start inside the record, so it never exceeds
    what the record can hold, whatever the entry says.
    """
    position = position if isinstance(position, Column) else F.lit(position)
    offset = B.u32(body, position)
    if compact:
        length = B.uint(body, position + F.lit(4), 2)
        declared = B.uint(body, position + F.lit(6), 2)
    else:
        length = B.u32(body, position + F.lit(4))
        declared = B.u32(body, position + F.lit(8))
    size = F.length(body).cast("long")
    usable = (offset > 0) & (offset < size) & (length > 0) & (declared > 0)
    inside = F.ceil((size - offset) / F.greatest(length, F.lit(1).cast("long")))
    count = F.when(usable, F.least(declared, inside)).otherwise(F.lit(0).cast("long"))
    return F.struct(offset.alias("offset"), length.alias("length"), count.alias("count"))


def section_column(name: str) -> Section:
    """The section held in a struct column made by :func:`directory_entry`."""
    return Section(F.col(f"{name}.offset"), F.col(f"{name}.length"), F.col(f"{name}.count"))


def directory_position(directory: int, index: int, compact: bool) -> int:
    return directory + index * (COMPACT if compact else WIDE)
