"""Array reading of entries against the column expressions, field by field."""

import random

import pytest
from pyspark.sql import functions as F

from acctlake.fixtures import trial as T
from acctlake.functions import binary as B
from acctlake.operators import header
from acctlake.operators import layouts as L
from acctlake.operators.decode import decode_table, sections_of
from acctlake.operators.entries import layout_rows, section_rows
from acctlake.operators.route import records_of, route
from acctlake.operators.sections import section_column
from acctlake.sources.rdw import read_records

KINDS = ["u8", "u16", "u32", "u64", "text", "hex", "hexfloat", "seconds", "seconds64", "millis", "flag"]


def expression(kind, body, at, end):
    return {
        "u8": lambda: B.u8(body, at, end), "u16": lambda: B.u16(body, at, end), "u32": lambda: B.u32(body, at, end),
        "u64": lambda: B.u64(body, at, end), "text": lambda: B.text(body, at, 8, end),
        "hex": lambda: B.hex_text(body, at, 8, end), "hexfloat": lambda: B.hexfloat(body, at, end),
        "seconds": lambda: B.seconds(B.u32(body, at, end)), "millis": lambda: B.millis(B.u32(body, at, end)),
        "seconds64": lambda: B.seconds(B.u64(body, at, end).cast("double")), "flag": lambda: B.flag(body, at, end),
    }[kind]()


@pytest.mark.parametrize("ascii_only", [True, False])
def test_fields_as_the_expressions_read_them(spark, ascii_only):
    rng = random.Random(2)
    octet = lambda: rng.choice([0x40, 0, 0xC1, 0xF0, 0xE9]) if ascii_only else rng.randrange(256)
    rows = []
    for i in range(60):
        size, length = rng.randint(0, 200), rng.randint(1, 24)
        body = bytes(octet() for _ in range(10 + size))
        count = min(rng.randint(0, 12), -(-size // length))
        rows.append((i, bytearray(body), (10, length, count)))
    records = spark.createDataFrame(rows, "id long, body binary, _row struct<offset: long, length: long, count: long>")
    fields = tuple(L.Field(f"{k}_{o}", k, "row", o, 8 if k in ("text", "hex") else 0) for k in KINDS for o in (0, 3))
    got = section_rows(records, fields)
    wanted = records.where("_row.count > 0").withColumn("_entry", F.explode(F.expr("sequence(0L, _row.count - 1)")))
    start = F.col("_row.offset") + F.col("_entry") * F.col("_row.length")
    end = F.least(F.length("body").cast("long"), start + F.col("_row.length"))
    expected = wanted.select(
        "id", "_entry", *[expression(f.kind, F.col("body"), start + F.lit(f.offset), end).alias(f.name) for f in fields]
    )
    assert [t for _, t in got.select(expected.columns).dtypes] == [t for _, t in expected.dtypes]
    order = lambda df: sorted(map(str, df.select(expected.columns).collect()))
    assert order(got) == order(expected)


def test_valid_bit_and_no_entries(spark):
    rows = [(1, bytearray(b"\x00\x80\x01\x00\x02\x80"), (0, 2, 3)), (2, bytearray(b"\x80"), (0, 2, 0))]
    records = spark.createDataFrame(rows, "id long, body binary, _row struct<offset: long, length: long, count: long>")
    got = section_rows(records, (L.Field("n", "u8", "row", 0),), (1, 0x80)).collect()
    assert [(r.id, r._entry, r.n) for r in got] == [(1, 0, 0), (1, 2, 2)]


def _whole_fields(layout):
    """Fields of the record by the column expressions."""
    body, out = F.col("body"), {}
    for f in layout.fields:
        if f.section != "row":
            section = section_column(f"_s{f.section}")
            end = section.entry_end(body, F.lit(0))
            at = section.offset + F.lit(f.offset)
            out[f.name] = B.text(body, at, f.width, end) if f.kind == "text" else expression(f.kind, body, at, end)
    if layout.interval:
        product = section_column("_s0")
        end = product.entry_end(body, F.lit(0))
        at = {name: product.offset + F.lit(place) for name, place in L.PRODUCT.items()}
        known = {
            L.START: B.day_time(B.packed_date(body, at["date"], end), B.u32(body, at["time"], end)),
            L.SPAN: B.millis(B.u32(body, at["interval"], end)), L.SAMPLES: B.u16(body, at["samples"], end),
            L.PLEX: B.text(body, at["sysplex"], L.PRODUCT["sysplex_width"], end),
        }
        out |= {name: known[name] for name in layout.interval}
    return out


@pytest.mark.parametrize("table", ["smf30", "smf71-1", "smf74-3", "smf72-3", "smf1154-1"])
def test_records_as_the_expressions_read_them(spark, table):
    """Also records whose directory points anywhere, and empty ones."""
    layout, rng, rows = L.BY_TABLE[table], random.Random(5), [(0, bytearray())]
    width = 2 if layout.compact else 4
    days = [b"\x20\x24\x36\x6c", b"\x20\x23\x36\x6c", b"\x19\x59\x00\x1c", b"\x20\x24\x00\x0c", b"\x20\x2a\x00\x1c", b"\x21\x00\x36\x5c"]
    for i in range(1, 300):
        body = bytearray(rng.choice([0x40, 0, 1, 0xC1, 0xE9, rng.randrange(256)]) for _ in range(rng.randint(20, 400)))
        for k in range(5):
            at = layout.directory + k * layout.entry_bytes
            offset = rng.choice([0, rng.randint(30, 420), rng.randint(60, 200)])
            body[at : at + layout.entry_bytes] = b"".join(
                n.to_bytes(w, "big") for n, w in
                ((offset, 4), (rng.choice([0, 3, 48, 60, 200]), width), (rng.choice([0, 1, 2, 9, 60000]), width)))
            if rng.random() < 0.7 and offset:
                body[offset + 13 : offset + 17] = rng.choice(days)
        rows.append((i, body))
    records = spark.createDataFrame(rows, "id long, body binary")
    got = layout_rows(records, layout)
    sections = sections_of(records, layout)
    wanted = sections.select("*", *[v.alias(n) for n, v in _whole_fields(layout).items()])
    names = ["id", *_whole_fields(layout)]
    if layout.rows is not None:
        fields = tuple(f for f in layout.fields if f.section == "row")
        wanted = section_rows(wanted, fields)
        names += ["_entry", *[f.name for f in fields]]
    assert [t for _, t in got.select(names).dtypes] == [t for _, t in wanted.select(names).dtypes]
    order = lambda df: sorted(map(str, df.select(names).collect()))
    assert order(got) == order(wanted)
    assert len(order(got)) > 10


@pytest.mark.parametrize("table", sorted(L.BY_TABLE))
def test_values_are_not_worked_out_one_by_one(spark, table):
    """A number as a column expression is hexadecimal text first, and the directory is read again for each: no such step is left."""
    header = ", ".join(f"`{n}` {k}" for n, k in L.COMMON_COLUMNS.items() if n != "ingest_ts")
    records = spark.createDataFrame([], f"{header}, record_seq long, file_hash string, body binary")
    decoded = decode_table(records, table)
    assert dict(decoded.dtypes) == L.columns_of(table)
    assert "conv(" not in decoded._jdf.queryExecution().optimizedPlan().toString()


def test_headers_as_the_expressions_read_them(spark):
    """Standard and extended headers, cut short anywhere, with any bytes; also without a body."""
    rng, rows = random.Random(7), [(0, None, "cut off"), (1, bytearray(), None)]
    for i in range(2, 400):
        body = bytearray(rng.choice([0x40, 0, 0xC1, 0xFF, rng.randrange(256)]) for _ in range(rng.choice([60, 60, rng.randint(0, 40)])))
        if rng.random() < 0.5:
            body[:4] = rng.choice([b"\xff\xff\x04\x82", b"\xff\xff\x01\x00"])
        for at in (8, 14):
            body[at : at + 4] = rng.choice([b"\x20\x24\x36\x6c", b"\x20\x23\x36\x6c", b"\x21\x01\x00\x1c", bytes(body[at : at + 4])])
        rows.append((i, body, None))
    records = spark.createDataFrame(rows, "record_seq long, body binary, error string")
    body, extended = F.col("body"), B.u16(F.col("body"), 0) == F.lit(header.EXTENDED_MARK)
    at = {name: F.when(extended, F.lit(header.EXTENDED[name])).otherwise(F.lit(place)) for name, place in header.STANDARD.items()}
    kind = F.when(extended, B.u16(body, 2)).otherwise(B.uint(body, 3, 1).cast("int"))
    short = (F.length(body) < 20) | (extended & (F.length(body) < 32))
    wanted = records.select(
        "record_seq", "body", F.coalesce("error", F.when(short, F.lit("short record"))).alias("error"),
        B.day_time(B.packed_date(body, at["date"]), B.u32(body, at["time"])).alias("smf_timestamp"),
        B.packed_date(body, at["date"]).alias("smf_date"), B.text(body, at["system"], 4).alias("system_id"),
        F.when(kind == 1154, F.lit("")).otherwise(B.text(body, at["subsystem"], 4)).alias("subsystem_id"),
        kind.alias("record_type"), B.u16(body, at["subtype"]).alias("subtype"), B.u8(body, at["flags"]).alias("flags"),
    )
    got = header.decode_header(records)
    assert got.dtypes == wanted.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))
    chosen = route(records.withColumn("source_file", F.lit("a"))).where("table_name = 'smf30'")
    assert "conv(" not in chosen._jdf.queryExecution().optimizedPlan().toString()


def test_only_wanted_columns_are_read(spark, sf_dir):
    """Columns that a query leaves out do not go through the batches; the others are the same."""
    records = records_of(route(read_records(spark, T.table_log(spark, sf_dir, "smf74-2m"))), "smf74-2m")
    shown = ["system_id", "sysplex_name", "member_name", "signals_sent"]
    some = decode_table(records, "smf74-2m", columns=shown)
    assert some.columns == shown
    every = decode_table(records, "smf74-2m").select(shown)
    assert some.exceptAll(every).count() == 0 and every.exceptAll(some).count() == 0
    plan = T.table_rows(spark, sf_dir, "smf74-2m")._jdf.queryExecution().optimizedPlan().toString()
    read = next(line for line in plan.splitlines() if "MapInArrow each" in line)
    assert "member_name" in read and "source_file" not in read and "file_hash" not in read
