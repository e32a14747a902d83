"""Framing: damaged files, ranges of one large file, wrong guesses, and random logs."""

import random
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from logs import finish, framed, header, write
from pyspark.sql import functions as F

from acctlake.sources import rdw


@pytest.fixture(autouse=True)
def any_range_size(monkeypatch):
    monkeypatch.setattr(rdw, "HASH_BLOCK", 1)


def frames(spark, path, **more):
    rows = rdw.read_records(spark, path, **more).collect()
    return sorted(
        (r.source_file.rsplit("/", 1)[-1], r.record_seq, r.byte_offset,
         None if r.body is None else bytes(r.body), r.error)
        for r in rows
    )


def brute_force(name, data):
    """The same chain, walked one record at a time."""
    out, at, seq = [], 0, 0
    while at < len(data):
        length = int.from_bytes(data[at : at + 2], "big") if at + 4 <= len(data) else None
        if length is None or (length >= 4 and at + length > len(data)):
            out.append((name, seq, at, None, rdw.CUT_OFF))
            return out
        if length < 4:
            out.append((name, seq, at, None, rdw.BAD_LENGTH))
            return out
        error = rdw.SEGMENTED if data[at + 2 : at + 4] != b"\0\0" else None
        out.append((name, seq, at, data[at + 4 : at + length], error))
        at, seq = at + length, seq + 1
    return out


def record(i, size=40):
    body = finish(header(30, 4, system=f"SY{i % 10}A"))
    return finish(body + bytes([i % 251]) * (size - len(body)))


def test_empty_file(spark, tmp_path):
    assert frames(spark, write(tmp_path, "a.bin", b"")) == []


def test_cut_off_record_keeps_the_earlier_ones(spark, tmp_path):
    data = framed(record(1)) + framed(record(2)) + framed(record(3))[:-5]
    got = frames(spark, write(tmp_path, "a.bin", data))
    assert got == brute_force("a.bin", data)
    assert [r[4] for r in got] == [None, None, rdw.CUT_OFF]


def test_bad_length_ends_the_file(spark, tmp_path):
    data = framed(record(1)) + b"\0\3\0\0" + framed(record(2))
    got = frames(spark, write(tmp_path, "a.bin", data))
    assert [r[4] for r in got] == [None, rdw.BAD_LENGTH]


def test_segmented_record_is_marked_and_the_walk_goes_on(spark, tmp_path):
    data = framed(record(1)) + framed(record(2), segment=0x0100) + framed(record(3))
    got = frames(spark, write(tmp_path, "a.bin", data))
    assert [r[4] for r in got] == [None, rdw.SEGMENTED, None]


def test_several_files(spark, tmp_path):
    expected = []
    for k in range(5):
        data = b"".join(framed(record(i, 30 + (i * k) % 50)) for i in range(20 * k))
        write(tmp_path, f"f{k}.bin", data)
        expected += brute_force(f"f{k}.bin", data)
    odd = "a b%20+ü.bin"
    data = framed(record(1))
    write(tmp_path / "deep er", odd, data)
    expected += brute_force(odd, data)
    assert frames(spark, str(tmp_path)) == sorted(expected)


@pytest.mark.parametrize("range_bytes", [500, 4096, 100_000])
def test_ranges_of_one_file(spark, tmp_path, range_bytes):
    rng = random.Random(7)
    data = b"".join(framed(record(i, rng.randint(22, 300))) for i in range(900))
    assert len(data) > range_bytes
    got = frames(spark, write(tmp_path, "big.bin", data), range_bytes=range_bytes)
    assert got == brute_force("big.bin", data)


def test_record_longer_than_a_range(spark, tmp_path):
    data = b"".join(framed(record(i, 40 if i % 3 else 5000)) for i in range(60))
    got = frames(spark, write(tmp_path, "big.bin", data), range_bytes=700)
    assert got == brute_force("big.bin", data)


def test_bodies_that_look_like_records(spark, tmp_path):
    """Every body holds a false chain of prefixes, so most guesses are wrong."""
    lure = b"".join(struct.pack(">HHH", 24, 0, 20) + bytes(18) for _ in range(40))
    data = b"".join(framed(finish(header(30, 4) + bytes(i % 7) + lure)) for i in range(40))
    got = frames(spark, write(tmp_path, "big.bin", data), range_bytes=1500)
    assert got == brute_force("big.bin", data)


def test_damage_in_an_early_range_ends_the_file(spark, tmp_path):
    good = b"".join(framed(record(i, 60)) for i in range(100))
    data = good + b"\0\1\0\0" + good
    got = frames(spark, write(tmp_path, "big.bin", data), range_bytes=1000)
    assert got == brute_force("big.bin", data)
    assert got[-1][4] == rdw.BAD_LENGTH


def test_content_hash_does_not_depend_on_ranges_or_names(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rdw, "HASH_BLOCK", 1000)
    data = b"".join(framed(record(i, 60)) for i in range(200))
    write(tmp_path, "a.bin", data)
    write(tmp_path, "b.bin", data)
    write(tmp_path, "c.bin", data[:-1] + b"\1")

    def hashes(range_bytes):
        rows = rdw.read_records(spark, str(tmp_path), range_bytes=range_bytes)
        return {r.source_file[-5]: r.file_hash for r in rows.select("source_file", "file_hash").distinct().collect()}

    whole, cut = hashes(1_000_000), hashes(3000)
    assert whole == cut
    assert whole["a"] == whole["b"] != whole["c"]


@pytest.mark.parametrize("inner", ["less the prefix", "whole", "zero"])
def test_number_of_jobs_does_not_depend_on_ranges(spark, tmp_path, inner):
    def one(i):
        body = bytearray(record(i, 60 + i % 90))
        number = {"less the prefix": len(body), "whole": len(body) + 4, "zero": 0}[inner]
        body[0:2] = struct.pack(">H", number)
        return framed(bytes(body))

    data = b"".join(one(i) for i in range(1200))
    path = write(tmp_path, "big.bin", data)
    tracker = spark.sparkContext.statusTracker()

    def jobs(range_bytes):
        spark.sparkContext.setJobGroup(f"{inner}-{range_bytes}", "")
        got = frames(spark, path, range_bytes=range_bytes)
        assert got == brute_force("big.bin", data)
        return len(tracker.getJobIdsForGroup(f"{inner}-{range_bytes}"))

    few, many = jobs(40_000), jobs(2_000)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert few == many


def test_every_entry_leaves_where_a_walk_does():
    rng = random.Random(3)
    for size in (0, 3, 500, 70_000, 200_000):
        data = rng.randbytes(size) if size < 1000 else b"".join(framed(rng.randbytes(rng.randint(0, 300))) for _ in range(size // 150))
        for span in {1, len(data) // 2, max(1, len(data) - 10), max(1, len(data))}:
            leaves = rdw._leaves(data, span)
            for entry in [*range(0, min(400, rdw.LONGEST)), *(rng.randrange(rdw.LONGEST) for _ in range(400))]:
                starts, stop, error = rdw._walk(data, entry, span)
                past, frames_, broke = leaves[entry]
                assert (frames_, broke) == (len(starts) + (error is not None), error is not None)
                assert error or past == stop - span


@pytest.mark.parametrize("fan", [2, 3])
def test_many_levels_of_tables(spark, tmp_path, monkeypatch, fan):
    """Files of one to hundreds of ranges, one that breaks in the middle, one whose records are longer than ranges."""
    rng = random.Random(fan)
    monkeypatch.setattr(rdw, "FAN", fan)
    logs = {
        "long.bin": b"".join(framed(rng.randbytes(rng.randint(0, 90))) for _ in range(900)),
        "mid.bin": b"".join(framed(rng.randbytes(rng.randint(0, 90))) for _ in range(60)),
        "one.bin": framed(record(1)),
        "wide.bin": b"".join(framed(rng.randbytes(n)) for n in (65_000, 3, 20_000, 0, 5)),
    }
    logs["broken.bin"] = logs["long.bin"][:20_000] + logs["long.bin"]
    expected = []
    for name, data in logs.items():
        write(tmp_path, name, data)
        expected += brute_force(name, data)
    assert frames(spark, str(tmp_path), range_bytes=2500) == sorted(expected, key=lambda r: r[:3])


def test_a_task_goes_through_few_tables_of_a_file(spark, tmp_path, monkeypatch):
    """The longest run of neighbours that is composed or followed does not grow with the number of ranges."""
    monkeypatch.setattr(rdw, "FAN", 4)
    seen = []

    def watched(nodes, tasks, *first):
        out = plain(nodes, tasks, *first)
        group = F.expr("node div 4")
        kept = nodes.where("leave IS NOT NULL").groupBy("source_file", group).count()
        seen.append(kept.agg(F.max("count")).first()[0])
        return out

    plain = rdw._neighbours
    monkeypatch.setattr(rdw, "_neighbours", watched)
    path = write(tmp_path, "a.bin", b"".join(framed(record(i)) for i in range(400)))
    rdw.read_records(spark, path, range_bytes=400).count()
    assert len(seen) == 2 + 3 and max(seen) <= 4


def test_composed_tables_are_the_table_of_the_whole():
    rng = random.Random(9)
    data = b"".join(framed(rng.randbytes(rng.randint(0, 300))) for _ in range(1500))
    half, end = len(data) // 2, len(data) - 40
    both = rdw._after(rdw._leaves(data[: half + rdw.LONGEST], half), rdw._leaves(data[half:], end - half))
    whole = rdw._leaves(data, end)
    alive = whole["broke"] == 0
    assert (both["frames"] == whole["frames"]).all() and (both["broke"] == whole["broke"]).all()
    assert (both["past"][alive] == whole["past"][alive]).all()


def test_ranges_must_be_whole_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rdw, "HASH_BLOCK", 1024)
    path = write(tmp_path, "a.bin", framed(record(1)))
    for wrong in (0, -1024, 1500):
        with pytest.raises(ValueError, match="multiple of 1024"):
            rdw.read_records(spark, path, range_bytes=wrong)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(
    sizes=st.lists(st.integers(0, 400), min_size=1, max_size=60),
    tail=st.binary(max_size=8),
    range_bytes=st.integers(50, 3000),
    seed=st.integers(0, 2**16),
)
def test_any_log(spark, tmp_path_factory, sizes, tail, range_bytes, seed):
    rng = random.Random(seed)
    data = b"".join(framed(rng.randbytes(n), rng.choice([0, 0, 0, 256])) for n in sizes) + tail
    folder = write(tmp_path_factory.mktemp("any"), "any.bin", data)
    assert frames(spark, folder, range_bytes=range_bytes) == brute_force("any.bin", data)


def test_a_range_is_read_in_pieces(monkeypatch, tmp_path):
    # Cut after 10, 1 000 and all bytes at a time: the same records, however the pieces fall.
    rng = random.Random(4)
    data = b"".join(framed(finish(header(30, 4) + bytes(rng.randrange(200)))) for _ in range(300)) + b"\0\3\0\0"
    write(tmp_path, "a.bin", data)
    row = {"source_file": str(tmp_path / "a.bin"), "length": len(data), "range_no": 0, "entry": 0, "first_seq": 0,
           "file_hash": None, "range_bytes": 1 << 20, "range_start": 0}
    class Read:
        def __init__(self, stream):
            self.stream = stream

        def __enter__(self):
            return self

        def __exit__(self, *problem):
            self.stream.close()

        def read_at(self, size, at):
            longest.append(size)
            return self.stream.read_at(size, at)

    class Files:
        def open_input_file(self, path):
            return Read(open_file(path))

    files, _ = rdw.locate(row["source_file"])
    open_file = files.open_input_file
    monkeypatch.setattr(rdw, "locate", lambda path: (Files(), path))
    seen = []
    for piece in (10, 1000, 1 << 20):
        longest = []
        monkeypatch.setattr(rdw, "BATCH_BYTES", piece)
        got = [r for b in rdw._emit_frames([rdw.pa.RecordBatch.from_pylist([row])]) for r in b.to_pylist()]
        assert [(r["record_seq"], r["byte_offset"], r["body"], r["error"]) for r in got] == [
            (seq, at, body, error) for _, seq, at, body, error in brute_force("a.bin", data)]
        assert max(longest) <= piece + rdw.LONGEST
        seen.append({r["file_hash"] for r in got})
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 1
