"""Rows out of records: all entries of a batch of records are read at once.

The bytes of a record are handed over as they are and come back as one row, or one row per entry of its row section, with
the fields as columns. Directories, values of the record and fields of entries are array operations over a whole batch, so the cost
of a field depends neither on how large its record is nor on how Spark generates code: as column expressions, each
value would work its place out of the directory again. The rules are those of :mod:`acctlake.functions.binary` and
:func:`acctlake.operators.sections.directory_entry`: a field that does not fit into its entry reads as 0, '' or NULL (dates).
"""

from __future__ import annotations

import sys
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, _parse_datatype_string

from acctlake.functions.binary import FIRST_YEAR, LAST_YEAR, MICROS_PER_DAY, MICROS_PER_HUNDREDTH
from acctlake.operators import layouts as L
from acctlake.operators.sections import WIDE

# The task functions travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries that are turned into rows at a time.
CHUNK = 1 << 16
#: Fixed value: code points of CP037, NUL shown as a blank.
_CP037 = np.array([0x20, *map(ord, bytes(range(1, 256)).decode("cp037"))], np.uint8)
#: A blank in CP037.
_BLANK = 0x40
_CPU_TYPE = L.CPU_ENTRY["type"]
_HEX = np.frombuffer(b"0123456789ABCDEF", np.uint8)

WIDTHS = {"u8": 1, "u16": 2, "u32": 4, "u64": 8, "hexfloat": 8, "seconds": 4, "seconds64": 8, "millis": 4, "flag": 1,
          "day": 4, "day_time": 8}


def _windows(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes from each place on, all of which lie in ``data``; each is copied as one item."""
    if not len(at):
        return np.zeros((0, width), np.uint8)
    items = np.ndarray(len(data) - width + 1, f"V{width}", data, strides=(1,))
    return items[at].view(np.uint8).reshape(len(at), width)


def _cut(data: np.ndarray, start: np.ndarray, end: np.ndarray, offset: int, width: int, absent: int = 0) -> np.ndarray:
    """``width`` bytes of each entry; ``absent`` where they do not fit."""
    at = start + offset
    fits = at + width <= end
    if fits.all():
        return _windows(data, at, width)
    found = np.full((len(at), width), absent, np.uint8)
    found[fits] = _windows(data, at[fits], width)
    return found


def _number(octets: np.ndarray) -> np.ndarray:
    """Big-endian unsigned numbers of up to 8 bytes."""
    padded = np.zeros((len(octets), 8), np.uint8)
    padded[:, 8 - octets.shape[1] :] = octets
    return padded.view(">u8")[:, 0].astype(np.uint64)


def _strings(octets: np.ndarray) -> pa.Array:
    """ASCII text, the whole of each row."""
    rows, width = octets.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.string(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(octets))])


def _text(data: np.ndarray, start: np.ndarray, end: np.ndarray, offset: int, width: int) -> pa.Array:
    """CP037 text without trailing blanks; cut at the end of the entry."""
    octets = _cut(data, start, end, offset, width, _BLANK)
    at = start + offset
    cut = np.flatnonzero((at < end) & (at + width > end))
    for left in np.unique(end[cut] - at[cut]):
        some = cut[end[cut] - at[cut] == left]
        octets[some, :left] = _windows(data, at[some], left)
    codes = np.frombuffer(octets.tobytes().translate(_CP037.tobytes()), np.uint8).reshape(octets.shape)
    if codes.max(initial=0) < 128:
        return pc.ascii_rtrim(_strings(codes), " ")
    wide = codes.astype(np.uint32).view(f"<U{width}")[:, 0]
    return pa.array([text.rstrip(" ") for text in wide.tolist()], pa.string())


def _days(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed ``YYYYDDD`` as days since 1970, and whether it is a real day in the believed years."""
    nibbles = np.stack([octets >> 4, octets & 15], axis=2).reshape(len(octets), 8)[:, :7]
    number = nibbles.astype(np.int64) @ 10 ** np.arange(6, -1, -1)
    year, day = number // 1000, number % 1000
    known = (nibbles <= 9).all(axis=1) & (year >= FIRST_YEAR) & (year <= LAST_YEAR)
    years = np.where(known, year - 1970, 0).astype("datetime64[Y]")
    first, after = (y.astype("datetime64[D]").astype(np.int64) for y in (years, years + 1))
    return first + day - 1, known & (day >= 1) & (day <= after - first)


def read_field(kind: str, data: np.ndarray, start: np.ndarray, end: np.ndarray, offset: int, width: int) -> pa.Array:
    """One field of all entries."""
    if kind == "text":
        return _text(data, start, end, offset, width)
    octets = _cut(data, start, end, offset, width or WIDTHS[kind])
    if kind == "day":
        days, known = _days(octets)
        return pa.array(days.astype(np.int32), mask=~known).cast(pa.date32())
    if kind == "day_time":
        # Hundredths of a second since midnight, then the date.
        days, known = _days(octets[:, 4:])
        micros = days * MICROS_PER_DAY + _number(octets[:, :4]).astype(np.int64) * MICROS_PER_HUNDREDTH
        return pa.array(micros, mask=~known).cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
    if kind == "hex":
        digits = np.empty((len(octets), 2 * width), np.uint8)
        digits[:, 0::2], digits[:, 1::2] = _HEX[octets >> 4], _HEX[octets & 15]
        return _strings(digits)
    if kind == "hexfloat":
        lead = octets[:, 0].astype(np.int64)
        size = _number(octets[:, 1:]).astype(np.float64) * np.exp2(((lead & 127) - 64) * 4.0 - 56.0)
        return pa.array(np.where(lead >= 128, -size, size))
    number = _number(octets)
    if kind == "u8":
        return pa.array(number.astype(np.int16))
    if kind == "u16":
        return pa.array(number.astype(np.int32))
    if kind == "u64":
        return pa.array(number).cast(pa.decimal128(20, 0))
    if kind in ("seconds", "seconds64"):
        return pa.array(number.astype(np.float64) / 100.0)
    if kind == "flag":
        return pa.array(number != 0)
    return pa.array(number.astype(np.int64) * (10 if kind == "millis" else 1))


@dataclass(frozen=True)
class _Places:
    """Per record, where a section lies in the bytes of a batch, how long an entry is, how many there are and where the record ends."""

    start: np.ndarray
    length: np.ndarray
    count: np.ndarray
    end: np.ndarray

    def first_end(self) -> np.ndarray:
        """End of the first entry; 0 for an absent section, so that nothing fits."""
        return np.where(self.count > 0, np.minimum(self.end, self.start + self.length), 0)

    def entries(self) -> tuple[np.ndarray, ...]:
        """Of every entry of the batch: its record, its number, its start and its end."""
        parent = np.repeat(np.arange(len(self.count)), self.count)
        entry = np.arange(len(parent)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        start = self.start[parent] + entry * self.length[parent]
        return parent, entry, start, np.minimum(self.end[parent], start + self.length[parent])


def bytes_of(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column, and where each value begins and the last one ends."""
    bounds = np.frombuffer(bodies.buffers()[1], np.int32)[bodies.offset : bodies.offset + len(bodies) + 1]
    data = bodies.buffers()[2]
    # A batch of empty values still has a byte to point at.
    return np.frombuffer(data if data else b"\0", np.uint8), bounds.astype(np.int64)


def _directory(data: np.ndarray, begin: np.ndarray, end: np.ndarray, at, compact: bool, there=True) -> _Places:
    """The directory entry ``at`` bytes into each record; no entries where it is not ``there``."""

    def number(offset: int, width: int) -> np.ndarray:
        return _number(_cut(data, begin + at, end, offset, width)).astype(np.int64)

    offset = number(0, 4)
    length, declared = (number(4, 2), number(6, 2)) if compact else (number(4, 4), number(8, 4))
    room = end - begin - offset
    usable = (offset > 0) & (room > 0) & (length > 0) & (declared > 0) & there
    # Declared entries that start inside the record, whatever the entry says.
    inside = -(-room // np.maximum(length, 1))
    return _Places(begin + offset, length, np.where(usable, np.minimum(declared, inside), 0), end)


def _emit(carried: list[pa.Array], data: np.ndarray, found: tuple[np.ndarray, ...], specs, valid_bit,
          names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of entries: what their records carry, ``_entry`` and the fields."""
    parent, entry, start, end = found
    if valid_bit is not None:
        place, mask = valid_bit
        kept = (_cut(data, start, end, place, 1)[:, 0] & mask) != 0
        parent, entry, start, end = parent[kept], entry[kept], start[kept], end[kept]
    for at in range(0, len(parent), CHUNK):
        some = slice(at, at + CHUNK)
        rows = pa.array(parent[some])
        yield pa.RecordBatch.from_arrays(
            [
                *[column.take(rows) for column in carried],
                pa.array(entry[some]),
                *[read_field(kind, data, start[some], end[some], o, w) for _, kind, o, w in specs],
            ],
            names,
        )


def _rolled_up(kind: str, code: int, offset: int, data: np.ndarray, found: tuple[np.ndarray, ...], records: int) -> pa.Array:
    """Per record, the count of, or milliseconds summed over, the processors of one type."""
    if offset < 0:
        # No offset is published: unknown, not zero.
        return pa.nulls(records, pa.int64())
    parent, _, start, end = found
    chosen = _cut(data, start, end, _CPU_TYPE, 1)[:, 0] == code
    parent, start, end = parent[chosen], start[chosen], end[chosen]
    total = np.zeros(records, np.int64)
    np.add.at(total, parent, 1 if kind == "cpu_count" else _number(_cut(data, start, end, offset, 4)).astype(np.int64) * 10)
    return pa.array(total)


def _record_value(kind: str, offset: int, width: int, code: int | None, data: np.ndarray, section: _Places) -> pa.Array:
    """A value of the whole record, for all records of a batch."""
    if kind.startswith("cpu_"):
        return _rolled_up(kind, code, offset, data, section.entries(), len(section.count))
    if kind == "u64_list":
        _, _, start, end = section.entries()
        bounds = np.concatenate([[0], np.cumsum(section.count)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), read_field("u64", data, start, end, 0, 8))
    return read_field(kind, data, section.start, section.first_end(), offset, width)


def _interval_fields(layout: L.Layout) -> tuple[L.Field, ...]:
    """Interval columns as fields of the product section."""
    at = L.PRODUCT
    known = {
        L.START: ("day_time", at["time"], 0), L.SPAN: ("millis", at["interval"], 0), L.SAMPLES: ("u16", at["samples"], 0),
        L.PLEX: ("text", at["sysplex"], at["sysplex_width"]),
    }
    return tuple(L.Field(name, kind, 0, o, w) for name, (kind, o, w) in ((n, known[n]) for n in layout.interval))


def layout_rows(records: DataFrame, layout: L.Layout, columns: Collection[str] | None = None) -> DataFrame:
    """The rows of one layout: all columns but ``body``, the interval columns and values of the record, and, if the layout
    has a row section, ``_entry`` and the fields of an entry, a row for each. With ``columns`` only those values and fields."""
    carried = [c for c in records.columns if c != "body"]
    given = records.select(*carried, "body")
    fields = [f for f in (*_interval_fields(layout), *layout.fields) if columns is None or f.name in columns]
    whole = [(f.name, f.section, (f.kind, f.offset, f.width, f.code)) for f in fields if f.section != "row"]
    specs = [(f.name, f.kind, f.offset, f.width) for f in fields if f.section == "row"]
    kinds = L.columns_of(layout.table)
    schema = StructType([
        *[given.schema[c] for c in carried],
        *[StructField(name, _parse_datatype_string(kinds[name])) for name, *_ in whole],
        *[StructField("_entry", LongType())] * (layout.rows is not None),
        *[StructField(name, _parse_datatype_string(kinds[name])) for name, *_ in specs],
    ])
    names = schema.names
    # Plain values: the layout classes need not be there where the tasks run.
    first, step, compact = layout.directory, layout.entry_bytes, layout.compact
    read, row_section, nested_in, valid_bit = layout.sections, layout.rows, layout.nested_in, layout.valid_bit

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, bounds = bytes_of(batch.column(len(carried)))
            begin, end = bounds[:-1], bounds[1:]

            sections = {k: _directory(data, begin, end, first + k * step, compact) for k in read}
            columns = batch.columns[:-1] + [_record_value(*how, data, sections[k]) for _, k, how in whole]
            if row_section is None:
                yield pa.RecordBatch.from_arrays(columns, names)
                continue
            if nested_in is None:
                rows = _directory(data, begin, end, first + row_section * step, compact)
            else:
                # The outer section starts with a u32 count, then its own directory of wide entries; offsets count from the start
                # of the record.
                outer = sections[nested_in]
                rows = _directory(data, begin, end, outer.start - begin + 4 + row_section * WIDE, False, outer.count > 0)
            yield from _emit(columns, data, rows.entries(), specs, valid_bit, names)

    return given.mapInArrow(each, schema)


def section_rows(
    records: DataFrame, fields: tuple[L.Field, ...], valid_bit: tuple[int, int] | None = None
) -> DataFrame:
    """One row per entry of the section in ``_row``: all columns but ``body`` and those that begin with ``_``, ``_entry``
    (its number) and the fields. Records without entries give no rows; with ``valid_bit`` (place, mask)
    entries need one of these bits."""
    carried = [c for c in records.columns if c != "body" and not c.startswith("_")]
    length, count = F.col("_row.length"), F.col("_row.count")
    # Entries may be cut short by the end of the record, never longer than it.
    size = F.least(length * count, F.length("body").cast("long") - F.col("_row.offset"))
    given = records.where(count > 0).select(
        *carried, length.alias("_length"), count.alias("_count"),
        F.substring("body", (F.col("_row.offset") + 1).cast("int"), size.cast("int")).alias("_rows"),
    )
    specs = [(f.name, f.kind, f.offset, f.width) for f in fields]
    types = [_parse_datatype_string(L.KIND_TYPES[f.kind]) for f in fields]
    schema = StructType([
        *[given.schema[c] for c in carried], StructField("_entry", LongType()),
        *[StructField(f.name, t) for f, t in zip(fields, types, strict=True)],
    ])
    names = schema.names

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, bounds = bytes_of(batch.column(len(carried) + 2))
            lengths, counts = (batch.column(len(carried) + i).to_numpy() for i in range(2))
            found = _Places(bounds[:-1], lengths, counts, bounds[1:]).entries()
            yield from _emit(batch.columns[: len(carried)], data, found, specs, valid_bit, names)

    return given.mapInArrow(each, schema)
