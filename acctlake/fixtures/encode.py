"""Rows to binary records, for round-trip checks. Values are column expressions; the bytes of repeated sections are made in Arrow
batches, all rows of a batch at once, everything else as column expressions too.

Records are spelled out byte run by byte run (values and fillers in order), not from the layout
table the decoder uses, so an offset that is wrong there cannot cancel out here. Every value is SQL
text that Spark and DuckDB both understand; the expected rows are a plain SELECT of it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from acctlake.sources.files import locate

# The file writer travels with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PRINTABLE = "".join(chr(c) for c in range(32, 127))
_EBCDIC = _PRINTABLE.encode("cp037").decode("latin-1")
#: What each ASCII byte becomes; the upper half is never looked up.
_ASCII_TO_EBCDIC = bytes(range(128)).decode("ascii").encode("cp037") + bytes(128)

#: Rows of equal record values share records if they lie in the same block of so many rows.
BLOCK_ROWS = 65536
#: So many entries of the widest kind still fit into one record.
RECORD_ROWS = 128


# -- byte runs, all as hexadecimal text ----------------------------------------------------------


def bits(value: str | Column, width: int) -> Column:
    """A number as a long; of eight bytes, as the long of the same 64 bits."""
    column = F.expr(value) if isinstance(value, str) else value
    if width < 8:
        return column.cast("bigint")
    # Only decimals go beyond 63 bits; the type is known before the plan runs, and the other branch leaves it.
    large = column.cast("decimal(20,0)")
    wrapped = F.when(large > F.lit((1 << 63) - 1), large - F.lit(Decimal(1 << 64))).otherwise(large)
    decimal = F.startswith(F.typeof(column), F.lit("decimal"))
    return F.when(decimal, wrapped.cast("bigint")).otherwise(column.cast("bigint"))


def number(value: str | Column, width: int) -> Column:
    return F.lpad(F.hex(bits(value, width)), 2 * width, "0")


def ebcdic(value: str | Column, width: int) -> Column:
    column = F.expr(value) if isinstance(value, str) else value
    # Blanks are added last: translating is by letter.
    shown = F.rpad(F.translate(column, _PRINTABLE, _EBCDIC), width, _EBCDIC[0])
    return F.hex(F.encode(shown, "ISO-8859-1"))


def hexfloat(sixteenths: str) -> Column:
    """An integer count of sixteenths as IBM 64-bit hexadecimal float."""
    digits = F.hex(F.expr(f"CAST({sixteenths} AS BIGINT)"))
    exponent = F.lpad(F.hex(F.lit(63) + F.length(digits)), 2, "0")
    return F.when(digits == "0", F.lit("0" * 16)).otherwise(
        F.concat(exponent, F.rpad(digits, 14, "0"))
    )


def packed_date(date: str) -> Column:
    # Formatting a date takes many times as long as its numbers.
    day = F.expr(date)
    return F.concat(
        F.lpad(F.year(day).cast("string"), 4, "0"), F.lpad(F.dayofyear(day).cast("string"), 3, "0"), F.lit("C")
    )


def filler(width: int) -> Column:
    return F.lit("00" * width)


@dataclass(frozen=True)
class Run:
    """A byte run: how it is written, and under which name and value the decoder must return it."""

    form: str
    width: int
    name: str | None = None
    value: str = ""
    expected: str | None = None

    def encoded(self) -> Column:
        return {
            "n": lambda: number(self.value, self.width),
            "t": lambda: ebcdic(self.value, self.width),
            "x": lambda: hexfloat(self.value),
            "pad": lambda: filler(self.width),
        }[self.form]()

    def given(self) -> Column:
        """The value as it goes into a batch."""
        return {
            "n": lambda: bits(self.value, self.width),
            "t": lambda: F.expr(self.value).cast("string"),
            "x": lambda: F.expr(self.value).cast("bigint"),
        }[self.form]()

    def sql(self) -> str:
        if self.expected is not None:
            return self.expected
        return f"({self.value}) / 16.0" if self.form == "x" else self.value


def n(width, name, value, expected=None):
    return Run("n", width, name, value, expected)


def t(width, name, value, expected=None):
    return Run("t", width, name, value, expected)


def x(name, sixteenths):
    return Run("x", 8, name, sixteenths)


def pad(width):
    return Run("pad", width)


@dataclass(frozen=True)
class Spec:
    """How rows of one source table become records of one type."""

    table: str
    source: str
    record_type: int
    subtype: int
    #: bytes between the subtype and the directory
    lead: int
    #: one item per directory entry: None, "product", or a list of runs; the lists in ``repeated``
    #: have one entry per source row
    sections: tuple
    repeated: tuple[int, ...] = ()
    compact: bool = False
    #: sections that hold several entries per row, by position: (count, bytes of one entry)
    arrays: dict | None = None
    interval: tuple[str, ...] = ()
    where: str | None = None
    #: expected columns that are not runs
    extra: tuple[tuple[str, str], ...] = ()

    def runs(self, row_section: int | None) -> list[Run]:
        """Named runs, leaving out repeated sections that feed another table."""
        return [
            r
            for k, s in enumerate(self.sections)
            if isinstance(s, tuple) and (k not in self.repeated or k == row_section)
            for r in s
            if r.name
        ]


# Values every record needs, per source table: they must be equal for all rows of one record.
RECORD_VALUES = {
    "lineitem": {
        "rec_date": "CAST(date_trunc('quarter', l_shipdate) AS DATE)",
        "rec_time": "quarter(l_shipdate) * 360000 + year(l_shipdate)",
        "rec_system": "concat('SYS', l_suppkey % 2)",
        "rec_interval": "year(l_shipdate) * 100",
        "rec_samples": "year(l_shipdate)",
        "rec_plex": "concat('PLEX', quarter(l_shipdate))",
        "rec_class": "concat('CLS', year(l_shipdate))",
    },
    "part": {
        "rec_date": "make_date(2000 + p_size % 30, 1 + p_size % 12, 1 + p_size % 28)",
        "rec_time": "p_partkey % 8640000",
        "rec_system": "concat('SYS', p_partkey % 2)",
        "rec_interval": "p_size * 6000",
        "rec_samples": "p_size * 1000",
        "rec_plex": "concat('PLEX', p_size % 3)",
        "rec_class": "'X'",
    },
    "orders": {
        "rec_date": "CAST(o_orderdate AS DATE)",
        "rec_time": "o_orderkey % 8640000",
        "rec_system": "concat('SYS', o_custkey % 4)",
        "rec_interval": "0",
        "rec_samples": "0",
        "rec_plex": "'PLEX1'",
        "rec_class": "'X'",
    },
    "events": {
        "rec_date": "CAST(ts AS DATE)",
        "rec_time": "hour(ts) * 360000 + minute(ts) * 6000 + CAST(floor(second(ts)) AS INT) * 100",
        "rec_system": "concat('SYS', user_id % 3)",
        "rec_interval": "0",
        "rec_samples": "0",
        "rec_plex": "''",
        "rec_class": "'X'",
    },
    "supplier": {
        "rec_date": "make_date(2025, 1 + CAST(s_suppkey % 12 AS INT), 10)",
        "rec_time": "s_suppkey * 100",
        "rec_system": "concat('SYS', s_nationkey % 4)",
        "rec_interval": "0",
        "rec_samples": "0",
        "rec_plex": "''",
        "rec_class": "'X'",
    },
}

_EXTENDED_FROM = 256


def record_header(record_type: int, subtype: str | int, subsystem: str = "JES2") -> Column:
    """Header with its length left as ``____``; for standard headers the subtype follows."""
    time, date = number("rec_time", 4), packed_date("rec_date")
    system = ebcdic("rec_system", 4)
    if record_type < _EXTENDED_FROM:
        return F.concat(
            F.lit(f"____00{record_type:02X}"), time, date, system, ebcdic(F.lit(subsystem), 4),
            number(F.expr(str(subtype)), 2),
        )
    return F.concat(
        F.lit(f"FFFF{record_type:04X}0000____0000"), time, date, system,
        number(F.expr(str(subtype)), 2), F.lit("0002"), filler(6),
    )


def finish(header: Column, *rest: Column, data: Sequence[Column] = ()) -> Column:
    """Fill the length into the header and turn the text into bytes, with ``data`` behind it as it is; what follows the header is
    not searched."""
    # Digits are single bytes, and characters would be counted one by one.
    digits = sum((F.octet_length(part) for part in rest), F.octet_length(header))
    size = sum((F.octet_length(part) for part in data), (digits / F.lit(2)).cast("bigint"))
    filled = F.unhex(F.replace(header, F.lit("____"), F.lpad(F.hex(size), 4, "0")))
    return F.concat(filled, *[F.unhex(part) for part in rest], *data)


def _product() -> Column:
    return F.concat(
        filler(1), ebcdic(F.lit("RMFPROD"), 8), number("rec_time", 4), packed_date("rec_date"),
        number("rec_interval", 4), number("rec_samples", 2), filler(5), ebcdic(F.lit("LEVEL1"), 8),
        filler(4), ebcdic("rec_plex", 8),
    )


def with_record_values(rows: DataFrame, source: str) -> DataFrame:
    return rows.select("*", *[F.expr(v).alias(k) for k, v in RECORD_VALUES[source].items()])


# -- entries of repeated sections, in batches ----------------------------------------------------


def _text_octets(column: pa.Array, width: int) -> np.ndarray:
    """CP037 text, filled up with blanks or cut to ``width``."""
    column = column.fill_null("")
    if not pc.all(pc.string_is_ascii(column)).as_py():
        rows = [text[:width].ljust(width).encode("cp037") for text in column.to_pylist()]
        return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width)
    if pc.max(pc.binary_length(column)).as_py() > width:
        column = pc.utf8_slice_codeunits(column, 0, width)
    # All of one length: their bytes lie one after the other.
    padded = pc.ascii_rpad(column, width).buffers()[2].to_pybytes()[: len(column) * width]
    return np.frombuffer(padded.translate(_ASCII_TO_EBCDIC), np.uint8).reshape(-1, width)


def _number_octets(numbers: np.ndarray, width: int) -> np.ndarray:
    """The last ``width`` bytes of numbers of 64 bits."""
    return numbers.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]


def _hexfloat_octets(sixteenths: np.ndarray) -> np.ndarray:
    digits = np.sum([sixteenths >= 1 << 4 * k for k in range(14)], axis=0, dtype=np.int64)
    shown = (63 + digits << 56) | (sixteenths << 4 * (14 - digits))
    return _number_octets(np.where(digits > 0, shown, 0), 8)


def _by_group(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch in groups of equal values, each in the order of the batch, and where each group begins."""
    codes = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        values = column.dictionary_encode(null_encoding="encode")
        if len(values.dictionary) > 1:
            codes = codes * len(values.dictionary) + values.indices.to_numpy()
            codes = pa.array(codes).dictionary_encode().indices.to_numpy().astype(np.int64)
    order = np.argsort(codes, kind="stable")
    return order, np.flatnonzero(np.diff(codes[order], prepend=-1))


class _Listed:
    """Values of a row that go to a batch as one list: a batch's size is taken after each row, column by column, and a list is as
    cheap in that as one number."""

    def __init__(self, kind: str):
        self.kind = kind
        self.values: dict[tuple, Column] = {}

    def place(self, key: tuple, value: Column) -> int:
        """Where the value is in the list; one that is asked for again is in it once."""
        self.values.setdefault(key, value)
        return list(self.values).index(key)

    def column(self) -> Column:
        return F.array(*[v.cast(self.kind) for v in self.values.values()]).cast(f"array<{self.kind}>")


_KEY_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "date": pa.date32()}


def entry_parts(rows: DataFrame, spec: Spec, keys: list[str]) -> DataFrame:
    """The rows of a batch that have equal ``keys`` and are of one block, as one row: their number ``_rows`` and, for each repeated
    section, the bytes ``_e<k>`` of their entries one after the other."""
    rows = rows.withColumn("_block", F.expr(f"monotonically_increasing_id() div {BLOCK_ROWS}"))
    listed = _Listed("bigint"), _Listed("string")
    groups = []
    for name in (*keys, "_block"):
        kind = rows.schema[name].dataType.simpleString()
        value = F.unix_date(name) if kind == "date" else F.col(name)
        text = kind == "string"
        groups.append((text, listed[text].place((name,), value), _KEY_TYPES[kind]))
    sections = []
    for k in spec.repeated:
        at, placed = 0, []
        for run in spec.sections[k]:
            if run.form != "pad":
                text = run.form == "t"
                key = (run.value,) if text else (run.form, run.width == 8, run.value)
                placed.append((run.form, listed[text].place(key, run.given()), at, run.width))
            at += run.width
        sections.append((at, placed))
    steps = [len(one.values) for one in listed]
    schema = StructType([
        *[rows.schema[name] for name in (*keys, "_block")], StructField("_rows", LongType()),
        *[StructField(f"_e{k}", BinaryType()) for k in spec.repeated],
    ])
    names = schema.names

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = [column.flatten() for column in batch.columns]
            numbers = flat[0].fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, steps[0])

            def one(text: bool, place: int) -> pa.Array:
                return flat[text].take(pa.array(np.arange(place, len(flat[text]), steps[text])))

            found = [one(text, place) for text, place, _ in groups]
            order, first = _by_group(found)
            bounds = np.append(first, len(order))
            entries = []
            for width, placed in sections:
                octets = np.zeros((len(order), width), np.uint8)
                for form, place, at, size in placed:
                    if form == "t":
                        octets[:, at : at + size] = _text_octets(one(True, place), size)
                    elif form == "x":
                        octets[:, at : at + size] = _hexfloat_octets(numbers[:, place])
                    else:
                        octets[:, at : at + size] = _number_octets(numbers[:, place], size)
                buffers = [None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(octets.take(order, axis=0))]
                entries.append(pa.Array.from_buffers(pa.binary(), len(first), buffers))
            leading = pa.array(order[first])
            shown = [
                (c.take(leading).cast(pa.int32()) if t == pa.date32() else c.take(leading)).cast(t)
                for c, (_, _, t) in zip(found, groups, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*shown, pa.array(np.diff(bounds)), *entries], names)

    return rows.select(*[one.column().alias(one.kind) for one in listed]).mapInArrow(each, schema)


def _cut_into_records(blocks: DataFrame, keys: list[str], widths: dict[int, int]) -> DataFrame:
    """Rows of ``_all`` entries, whose bytes are lists of parts, as rows of at most ``RECORD_ROWS``."""

    def record(first: Column) -> Column:
        return F.struct(
            F.least(F.col("_all") - first, F.lit(RECORD_ROWS)).alias("_rows"),
            *[
                F.substring(f"_e{k}", (first * F.lit(w) + F.lit(1)).cast("int"), F.lit(RECORD_ROWS * w)).alias(f"_e{k}")
                for k, w in widths.items()
            ],
        )

    def joined(k: int) -> Column:
        return F.aggregate(f"_e{k}", F.lit(bytearray()), lambda so_far, part: F.concat(so_far, part))

    firsts = F.sequence(F.lit(0).cast("long"), F.col("_all") - F.lit(1), F.lit(RECORD_ROWS).cast("long"))
    # The records are cut before they are exploded: what is beside an exploded list is copied for each of its items.
    return (
        blocks.select(*keys, "_all", *[joined(k).alias(f"_e{k}") for k in widths])
        .select(*keys, F.explode(F.transform(firsts, record)).alias("_record"))
        .select(*keys, "_record.*")
    )


def encode(rows: DataFrame, spec: Spec) -> DataFrame:
    """One ``body`` column: the records that hold the rows."""
    rows = with_record_values(rows if spec.where is None else rows.where(spec.where), spec.source)
    keys = list(RECORD_VALUES[spec.source])
    widths = {k: sum(r.width for r in s) for k, s in enumerate(spec.sections) if isinstance(s, tuple)}
    if spec.repeated:
        # A group holds at most the rows of one block, however often a key occurs, and a record at most RECORD_ROWS of them. What is
        # collected are the finished entries of a batch, not those of a row.
        blocks = (
            entry_parts(rows, spec, keys)
            .groupBy(*keys, "_block")
            .agg(F.sum("_rows").alias("_all"), *[F.collect_list(f"_e{k}").alias(f"_e{k}") for k in spec.repeated])
        )
        packed = _cut_into_records(blocks, keys, {k: widths[k] for k in spec.repeated})
    else:
        packed = rows.withColumn("_rows", F.lit(1))

    header = record_header(spec.record_type, spec.subtype)
    extended = spec.record_type >= _EXTENDED_FROM
    entry = 8 if spec.compact else 12
    at = F.lit((32 if extended else 22) + spec.lead + entry * len(spec.sections))
    directory, data = [], []
    for k, section in enumerate(spec.sections):
        if section is None:
            directory.append(filler(entry))
            continue
        count, size = F.lit(1), F.lit(48 if section == "product" else widths[k])
        length = size
        if section == "product":
            content = F.unhex(_product())
        elif k in spec.repeated:
            content, count = F.col(f"_e{k}"), F.col("_rows")
            size = count * length
        else:
            content = F.unhex(F.concat(*[r.encoded() for r in section]))
            if spec.arrays and k in spec.arrays:
                count_sql, each = spec.arrays[k]
                count, length = F.expr(count_sql), F.lit(each)
        small = 2 if spec.compact else 4
        directory.append(F.concat(number(at, 4), number(length, small), number(count, small)))
        data.append(content)
        at = at + size
    return packed.select(finish(header, F.concat(filler(spec.lead), *directory), data=data).alias("body"))


def encode_nested(rows: DataFrame, spec: Spec) -> DataFrame:
    """Extended-header records whose second section holds a directory of its own."""
    rows = with_record_values(rows, spec.source)
    common, entry = spec.sections
    entry_hex = F.concat(*[r.encoded() for r in entry])
    width = sum(r.width for r in entry)
    common_at, outer_at = 32 + 24, 32 + 24 + 64
    entry_at = outer_at + 4 + 12
    body = F.concat(
        F.lit(f"{common_at:08X}{64:08X}{1:08X}{outer_at:08X}{128:08X}{1:08X}"),
        F.concat(*[r.encoded() for r in common]),
        F.lit(f"{1:08X}{entry_at:08X}{width:08X}{1:08X}"),
        entry_hex,
        filler(128 - 16 - width),
    )
    return rows.select(finish(record_header(spec.record_type, spec.subtype), body).alias("body"))


# -- binary files --------------------------------------------------------------------------------


def write_logs(records: DataFrame, folder: str) -> DataFrame:
    """Write ``body`` rows as length-prefixed files, one per task; returns the file names.

    The caller must run an action on the result. A task that runs twice replaces its own file.
    """
    framed = records.select(
        F.concat(
            F.unhex(F.lpad(F.hex(F.length("body") + F.lit(4)), 4, "0")),
            F.unhex(F.lit("0000")),
            F.col("body"),
        ).alias("frame"),
        F.spark_partition_id().alias("part"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = locate(folder)
        filesystem.create_dir(inner, recursive=True)
        stream, name = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if stream is None:
                name = f"{inner}/log-{batch.column(1)[0].as_py():05d}.bin"
                stream = filesystem.open_output_stream(name + ".tmp")
            # The frames of a batch lie one after the other already.
            frames = batch.column(0)
            bounds = np.frombuffer(frames.buffers()[1], np.int32)
            first, last = int(bounds[frames.offset]), int(bounds[frames.offset + len(frames)])
            stream.write(frames.buffers()[2].slice(first, last - first))
        if stream is not None:
            stream.close()
            filesystem.move(name + ".tmp", name)
            yield pa.RecordBatch.from_pydict({"source_file": [name]})

    return framed.mapInArrow(write, "source_file string")
