"""Compaction: same rows in fewer files, concurrent readers, crashes, late runs, conflicts."""

import pytest
from pyspark.sql import functions as F

from acctlake.sources import compaction as C
from acctlake.sources import dataset as D
from acctlake.sources import manifest as M


def publish(spark, root, runs, ended=None, months=("03", "04"), table="smf30"):
    """A few rows of each run in each month and for two customers."""
    rows = spark.createDataFrame(
        [(f"J{r}", c, "S", "2025", m, f"R{r:04d}") for r in runs for m in months for c in ("A", "B")],
        "job_name string, customer string, path_system_id string, year string, month string, run_id string",
    )
    D.write_table(rows, D.folder_of(root, table))
    account = [(None, f"R{r:04d}", f"R{r:04d}", 1, f"R{r:04d}") for r in (runs if ended is None else ended)]
    spark.createDataFrame(account, D.FILES_SCHEMA).write.mode("append").parquet(f"{root}/{D.FILES}")


def rows_of(spark, root, **chosen):
    return sorted(tuple(r) for r in D.read_table(spark, root, "smf30", **chosen).select(
        "job_name", "customer", "month", "run_id").collect())


def files_read(spark, root, table="smf30"):
    return D.read_table(spark, root, table).select(F.input_file_name()).distinct().collect()


@pytest.fixture()
def root(spark, tmp_path):
    publish(spark, str(tmp_path), range(30))
    return str(tmp_path)


def test_many_runs_become_few_files_with_the_same_rows(spark, root):
    publish(spark, root, [30], ended=[])  # has not ended: stays as it is
    before = rows_of(spark, root)
    assert len(files_read(spark, root)) >= 4 * 31
    assert C.compact(spark, root, "smf30", [(2025, 3), (2025, 4), (2025, 5)]) == {(2025, 3): 30, (2025, 4): 30}
    assert rows_of(spark, root) == before
    assert len(files_read(spark, root)) <= 4 + 4
    assert [r for r in rows_of(spark, root, customer="A", year=2025, month=3)] == [r for r in before if r[1:3] == ("A", "03")]
    assert C.vacuum(spark, root, "smf30") == 0  # not old enough
    assert C.vacuum(spark, root, "smf30", retention=0) == 2 * 2 * 30
    assert rows_of(spark, root) == before
    assert len(D.read_folders(spark, root, "smf30").inputFiles()) == len(files_read(spark, root))
    assert C.compact(spark, root, "smf30", [(2025, 3)]) == {}


def test_a_reader_that_has_begun_ends_with_the_rows_it_saw(spark, root):
    reader = D.read_table(spark, root, "smf30").select("job_name", "run_id")
    expected = reader.count()
    C.compact(spark, root, "smf30", [(2025, 3), (2025, 4)])
    assert reader.count() == expected == len(reader.collect())


@pytest.mark.parametrize("first", [True, False])
def test_crash_between_write_and_publishing(spark, root, monkeypatch, first):
    if not first:
        C.compact(spark, root, "smf30", [(2025, 3)])
        publish(spark, root, [40])
    before = rows_of(spark, root)
    with monkeypatch.context() as m:
        # The driver dies: neither is the manifest published nor does anything clean up.
        m.setattr(M, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        m.setattr(C, "remove", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            C.compact(spark, root, "smf30", [(2025, 3), (2025, 4)])
    assert rows_of(spark, root) == before
    assert len(C._folders(spark, root, "smf30", run=f"{M.MERGED}*")) > (0 if first else 2)
    C.compact(spark, root, "smf30", [(2025, 3), (2025, 4)])
    assert rows_of(spark, root) == before
    C.vacuum(spark, root, "smf30", retention=0)
    assert rows_of(spark, root) == before
    assert len(C._folders(spark, root, "smf30")) == 4


def test_half_written_manifest_does_not_count(spark, root, tmp_path):
    C.compact(spark, root, "smf30", [(2025, 3)])
    before = rows_of(spark, root)
    (tmp_path / M.FOLDER / "smf30" / "0000000002.json").write_text('[{"year": "20')
    assert M.read(spark, root, "smf30").version == 1 and rows_of(spark, root) == before
    publish(spark, root, [50])
    assert C.compact(spark, root, "smf30", [(2025, 3)]) == {(2025, 3): 2}
    assert M.read(spark, root, "smf30").version == 3 and len(rows_of(spark, root)) == len(before) + 4


def test_late_runs_are_read_beside_merged_rows_and_merged_next(spark, root):
    C.compact(spark, root, "smf30", [(2025, 3)])
    publish(spark, root, [60, 61], months=("03",))
    before = rows_of(spark, root)
    assert len(before) == 4 * 30 + 4
    assert C.compact(spark, root, "smf30", [(2025, 3)]) == {(2025, 3): 3}
    assert rows_of(spark, root) == before
    assert rows_of(spark, root, month=3) == [r for r in before if r[2] == "03"]


def test_two_compactions_at_once(spark, root, monkeypatch):
    before, write = rows_of(spark, root), D.write_table
    with monkeypatch.context() as m:
        def other_first(*args, **kwargs):
            m.setattr(D, "write_table", write)
            C.compact(spark, root, "smf30", [(2025, 4)])
            write(*args, **kwargs)

        m.setattr(D, "write_table", other_first)
        with pytest.raises(M.Conflict):
            C.compact(spark, root, "smf30", [(2025, 3)])
    assert rows_of(spark, root) == before
    assert len(C._folders(spark, root, "smf30", "2025", "03")) == 2 * 30


def test_rows_that_differ_are_not_published(spark, root, monkeypatch):
    before, write = rows_of(spark, root), D.write_table
    monkeypatch.setattr(D, "write_table", lambda rows, *a, **k: write(rows.where("job_name <> 'J7'"), *a, **k))
    with pytest.raises(RuntimeError, match="not those of the runs"):
        C.compact(spark, root, "smf30", [(2025, 3)])
    assert rows_of(spark, root) == before and M.read(spark, root, "smf30").version == 0


def test_header_only_tables_and_tables_without_months(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame(
        [(t, "S", "A", "S", "2025", "03", f"R{r}") for t in ("smf99-1", "smf72-1") for r in range(3)],
        "table_name string, system_id string, customer string, path_system_id string, year string, month string, run_id string",
    )
    D.write_table(rows, f"{root}/{D.HEADER_ONLY}", by_table=True)
    spark.createDataFrame([(None, f"R{r}", "h", 1, f"R{r}") for r in range(3)], D.FILES_SCHEMA).write.parquet(f"{root}/{D.FILES}")
    assert C.months_present(spark, root, "smf99-1") == [(2025, 3)] and C.months_present(spark, root, "smf99-1", (2025, 3)) == []
    assert C.compact(spark, root, "smf99-1", [(2025, 3)]) == {(2025, 3): 3}
    for table in ("smf99-1", "smf72-1"):
        assert sorted(r.run_id for r in D.read_table(spark, root, table).collect()) == ["R0", "R1", "R2"]
    assert len(files_read(spark, root, "smf99-1")) == 1 and len(files_read(spark, root, "smf72-1")) >= 3


def test_a_task_sorts_a_bounded_part():
    # Rows took 18 to 24 times their shuffled bytes in the sort: tasks of 384 MB needed more than an executor has.
    assert 25 * C.task_bytes(C.FILE_BYTES) < 3600 << 20
    assert C.task_bytes(1000) == 1000 * C.LARGER
