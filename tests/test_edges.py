"""Hostile and unusual records, routing, and the account of where everything went."""

import datetime as dt
import struct

import pytest
from logs import device_record, extended, finish, framed, header, write

from acctlake.operators.decode import decode_table
from acctlake.operators.route import records_of, route
from acctlake.plans.ingest import ingest
from acctlake.sources import dataset as D
from acctlake.sources.rdw import read_records


def decoded(spark, path, table):
    return decode_table(records_of(route(read_records(spark, path)), table), table)


def test_section_out_of_bounds_and_zero_entries_give_no_rows(spark, tmp_path):
    data = framed(device_record(1, offset=9999, sections=1)) + framed(device_record(0))
    assert decoded(spark, write(tmp_path, "a.bin", data), "smf74-1").count() == 0


def test_longest_record_without_the_section(spark, tmp_path):
    data = framed(device_record(1, length=32763 - 38, sections=1))
    assert len(data) == 32767
    path = write(tmp_path, "a.bin", data)
    assert decoded(spark, path, "smf74-1").count() == 0
    assert read_records(spark, path).where("error is null").count() == 1


def test_thousand_short_entries(spark, tmp_path):
    rows = decoded(spark, write(tmp_path, "a.bin", framed(device_record(1000))), "smf74-1").collect()
    assert len(rows) == 1000
    first = rows[0]
    # inside the 32-byte entry: filler values, without a wrap; behind its end: zero
    assert first.connect_ms == 0x40404040 * 10 == 10_779_525_760
    assert (first.active_ms, first.disconnect_ms, first.queue_depth) == (0, 0, 0)
    # no product section
    assert first.interval_start_ts is None
    assert (first.interval_ms, first.sample_count, first.sysplex_name) == (0, 0, "")
    assert sorted(r.entry_seq for r in rows) == list(range(1000))


def test_declared_count_is_bounded_by_the_record(spark, tmp_path):
    body = header(74, 1) + struct.pack(">I", 3) + bytes(24) + struct.pack(">III", 62, 32, 0xFFFFFFFF)
    data = framed(finish(body + b"\x40" * 70))
    assert decoded(spark, write(tmp_path, "a.bin", data), "smf74-1").count() == 3


@pytest.mark.parametrize("date", [b"\0\0\0\x0c", bytes.fromhex("2025000C"), bytes.fromhex("2025366C"),
                                  bytes.fromhex("1850100C"), bytes.fromhex("2A25100C")])
def test_implausible_dates_are_null(spark, tmp_path, date):
    body = bytearray(finish(header(30, 1)))
    body[8:12] = date
    row = route(read_records(spark, write(tmp_path, "a.bin", framed(bytes(body))))).first()
    assert row.smf_date is None and row.smf_timestamp is None and row.table_name == "smf30"


def test_known_header(spark, tmp_path):
    body = bytes.fromhex("001400FA00057E402025100CE2E8E2F1D1C5E2F2")
    row = route(read_records(spark, write(tmp_path, "a.bin", framed(body)))).select(
        "*").withColumn("smf_timestamp", D.F.col("smf_timestamp").cast("string")).first()
    assert row.smf_timestamp == "2025-04-10 01:00:00"
    assert (row.system_id, row.subsystem_id, row.record_type, row.subtype) == ("SYS1", "JES2", 250, 0)
    assert row.table_name == "raw" and bytes(row.body) == body


def test_extended_header(spark, tmp_path):
    data = framed(finish(extended(1154, 2))) + framed(finish(extended(1154, 7)))
    data += framed(finish(extended(2000, 5)))
    rows = route(read_records(spark, write(tmp_path, "a.bin", data))).orderBy("record_seq").collect()
    assert [(r.record_type, r.subtype, r.subsystem_id, r.table_name) for r in rows[:2]] == [
        (1154, 2, "", "smf1154-2"), (1154, 7, "", "smf1154-7")]
    assert (rows[2].record_type, rows[2].subtype, rows[2].table_name) == (2000, 0, "raw")


@pytest.mark.parametrize("record_type,subtype,name", [
    (30, 1, "smf30"), (30, 5, "smf30"), (98, 3, "smf98"), (70, 1, "smf70-1"), (70, 9, "smf70-9"),
    (74, 2, "smf74-2"), (74, 10, "smf74-10"), (99, 1, "smf99-1"), (99, 0, "smf99"), (113, 1, "smf113"),
    (113, 2, "smf113"), (113, 0, "smf113-0"), (113, 255, "smf113-255"), (110, 1, "raw"), (42, 0, "raw"),
])
def test_routes(spark, tmp_path, record_type, subtype, name):
    data = framed(finish(header(record_type, subtype)))
    assert route(read_records(spark, write(tmp_path, "a.bin", data))).first().table_name == name


def test_ingest_accounts_for_everything(spark, tmp_path):
    log = tmp_path / "log"
    write(log, "one.bin", b"".join([
        framed(finish(header(30, 4, system="0001"))),
        framed(finish(header(30, 4, system="A.B ", day=131))),
        framed(finish(header(30, 4, year=0, day=0))),
        framed(b"\0\x08\0\x1e\0\0\0\0"),  # shorter than a header
        framed(device_record(0)), framed(device_record(4)),
        framed(finish(header(72, 1))), framed(finish(header(200, 1))),
        framed(finish(header(30, 4)))[:-3],  # cut off
    ]))
    write(log, "two.bin", framed(finish(header(30, 4, system="0001"))))
    write(log, "empty.bin", b"")
    root = str(tmp_path / "lake")
    audit = {r.table_name: (r.disposition, r.records, r.rows) for r in
             ingest(spark, str(log), root, customer="ACME & Co").collect()}
    assert audit == {
        "smf30": ("typed", 4, 4), "smf74-1": ("typed", 2, 4), "smf72-1": ("header_only", 1, 1),
        "raw": ("raw", 1, 1), "malformed": ("malformed", 2, 2),
    }
    jobs = D.read_type(spark, root, "smf30")
    places = {(r.customer, r.path_system_id, r.system_id, r.year, r.month) for r in jobs.collect()}
    assert places == {
        ("ACME___Co", "0001", "0001", "2025", "04"), ("ACME___Co", "A_B", "A.B", "2025", "05"),
        ("ACME___Co", "SYS1", "SYS1", None, None),
    }
    assert jobs.where("path_system_id = '0001'").count() == 2
    bad = {r.error: r.byte_offset for r in D.read_malformed(spark, root).collect()}
    assert set(bad) == {"short record", "cut off"}
    # a view per type, and one per table whose name is longer
    assert set(D.create_views(spark, root)) == {"smf30", "smf72", "smf74", "smf74-1", "raw"}
    assert spark.sql("select * from `smf74-1`").count() == D.read_table(spark, root, "smf74-1").count()
    assert spark.table("smf72").first().subtype == 1
    assert D.read_audit(spark, root).count() == 5


def test_ingest_of_nothing(spark, tmp_path):
    log = tmp_path / "log"
    write(log, "empty.bin", b"")
    assert ingest(spark, str(log), str(tmp_path / "lake")).count() == 0
    assert not (tmp_path / "lake" / "smf30").exists()


def test_repeated_run_replaces_only_itself(spark, tmp_path):
    log, root = tmp_path / "log", str(tmp_path / "lake")
    write(log, "one.bin", framed(finish(header(30, 4))))
    for run in ("R1", "R2", "R2"):
        ingest(spark, str(log), root, run_id=run, ingest_ts=dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc))
    assert D.read_type(spark, root, "smf30").count() == 2
