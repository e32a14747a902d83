"""The account of an ingest: lost, doubled and broken records."""

import pytest
from logs import finish, framed, header, write
from pyspark.sql import functions as F

from acctlake.plans.ingest import account, stage
from acctlake.sources.rdw import list_logs, split_files


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("account")
    good = [framed(finish(header(30, 4, time=100 * i))) for i in range(9)]
    write(folder / "in", "whole.bin", b"".join(good))
    write(folder / "in", "broken.bin", b"".join(good[:4]) + b"\0\1\0\0" + good[5])
    write(folder / "in", "cut.bin", b"".join(good)[:-3])
    files = list_logs(spark, str(folder / "in"))
    return stage(split_files(files), str(folder / "staged")), files


def of(name):
    return F.col("source_file").endswith(name)


def test_complete_files_pass(staged, tmp_path):
    rows, files = staged
    assert account(rows, files, str(tmp_path / "a")).agg(F.sum("records")).first()[0] == 9 + 5 + 9


@pytest.mark.parametrize("name", ["whole.bin", "broken.bin", "cut.bin"])
def test_a_lost_tail_is_seen(staged, tmp_path, name):
    rows, files = staged
    last = {"whole.bin": 8, "broken.bin": 4, "cut.bin": 8}[name]
    with pytest.raises(RuntimeError, match=name):
        account(rows.where(~(of(name) & (F.col("record_seq") >= last))), files, str(tmp_path / "a"))


def test_a_double_and_a_gap_are_seen(staged, tmp_path):
    rows, files = staged
    wrong = rows.where(~(of("whole.bin") & (F.col("record_seq") == 5))).unionByName(
        rows.where(of("whole.bin") & (F.col("record_seq") == 3))
    )
    with pytest.raises(RuntimeError, match="whole.bin"):
        account(wrong, files, str(tmp_path / "a"))


def test_a_lost_file_is_seen(staged, tmp_path):
    rows, files = staged
    with pytest.raises(RuntimeError, match="cut.bin"):
        account(rows.where(~of("cut.bin")), files, str(tmp_path / "a"))
