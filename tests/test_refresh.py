"""Marts by touched months: equal to a full build, only touched months written, crashes, copies, a changed mapping."""

import datetime as dt

import pytest

from acctlake.fixtures.accounts import seed
from acctlake.plans import marts, refresh
from acctlake.plans.reports import export_csv
from acctlake.sources import compaction
from acctlake.sources import dataset as D
from acctlake.sources import manifest as M
from acctlake.streaming.incremental import latest_copies

COLUMNS = (
    "job_name string, smf_date date, system_id string, cpu_sec double, tcb_sec double, srb_sec double, ziip_sec double, "
    "elapsed_sec double, excp_count bigint, source_file string, file_hash string, customer string, path_system_id string, "
    "year string, month string, run_id string"
)


def publish(spark, root, run, months, job="Brand#12", source=None, n=3):
    source = source or f"{run}.bin"
    rows = []
    for month in months:
        date = None if month is None else dt.date(2025, month, 3)
        place = (None, None) if month is None else ("2025", f"{month:02d}")
        rows += [(job, date, "S1", 1.5 * i, 1.0, 0.5, 0.0, 9.0, i, source, f"h-{source}", "ACME", "S1", *place, run) for i in range(n)]
    D.write_table(spark.createDataFrame(rows, COLUMNS), f"{root}/smf30")
    spark.createDataFrame([(None, source, f"h-{source}", len(rows), run)], D.FILES_SCHEMA).write.mode("append").parquet(f"{root}/{D.FILES}")


def same_as_full_build(spark, root, target, patterns=None):
    rows = latest_copies(D.read_table(spark, root, "smf30"), D.read_files(spark, root))
    full = marts.define_marts(rows, patterns or seed(spark))
    stored = refresh.read_refreshed(spark, target)
    for name in ("dim_application", "fct_job_consumption", "agg_consumption_daily", "rpt_jobs_by_date"):
        columns = [c for c in full[name].columns if c not in ("year", "month")]
        got, want = (sorted(map(str, df.select(*columns).collect())) for df in (stored[name], full[name]))
        assert got == want, name


def builds(spark, target, table="fct_job_consumption"):
    return {p.split("/data/")[1] for p, _ in refresh._builds(spark, target) if f"/{table}/" in p}


@pytest.fixture()
def lake(spark, tmp_path):
    root, target = str(tmp_path / "lake"), str(tmp_path / "marts")
    publish(spark, root, "R1", [3, 4, 5])
    publish(spark, root, "R2", [5], job="")
    assert refresh.refresh_marts(spark, root, seed(spark), target) == [("2025", "03"), ("2025", "04"), ("2025", "05")]
    return root, target


def test_only_touched_months_are_built(spark, lake):
    root, target = lake
    same_as_full_build(spark, root, target)
    assert refresh.refresh_marts(spark, root, seed(spark), target) == []
    first = builds(spark, target)
    publish(spark, root, "R3", [6], job="NEW")
    publish(spark, root, "late", [4], job="Brand#11")
    before = refresh.read_refreshed(spark, target)
    seen = before["fct_job_consumption"].count()
    assert refresh.refresh_marts(spark, root, seed(spark), target) == [("2025", "04"), ("2025", "06")]
    new = builds(spark, target) - first
    assert {b.split("/build=")[0] for b in new} == {f"fct_job_consumption/year=2025/month={m}" for m in ("04", "06")}
    same_as_full_build(spark, root, target)
    # Whoever has read before goes on with the old months.
    assert before["fct_job_consumption"].count() == seen == 12
    assert refresh.vacuum_marts(spark, target) == 0
    assert refresh.vacuum_marts(spark, target, 0) == 3 + 3
    same_as_full_build(spark, root, target)


def test_copies_runs_that_have_not_ended_and_compaction(spark, lake):
    root, target = lake
    publish(spark, root, "again", [3, 4, 5], source="R1.bin")  # the same file once more
    D.write_table(D.read_table(spark, root, "smf30").where("run_id = 'R2'").selectExpr("* except (run_id)", "'dying' as run_id"), f"{root}/smf30")
    assert refresh.refresh_marts(spark, root, seed(spark), target) == [("2025", "03"), ("2025", "04"), ("2025", "05")]
    same_as_full_build(spark, root, target)
    assert refresh.read_refreshed(spark, target)["fct_job_consumption"].count() == 12
    compaction.compact(spark, root, "smf30", [(2025, 3), (2025, 4)])
    publish(spark, root, "R9", [4])
    compaction.compact(spark, root, "smf30", [(2025, 4)])
    assert refresh.refresh_marts(spark, root, seed(spark), target) == [("2025", "04")]
    same_as_full_build(spark, root, target)


def test_changed_mapping_builds_all_months(spark, lake):
    root, target = lake
    other = seed(spark).where("job_pattern <> 'Brand#12'")
    assert len(refresh.refresh_marts(spark, root, other, target)) == 3
    same_as_full_build(spark, root, target, other)


def test_failures_leave_the_last_version(spark, lake, monkeypatch):
    root, target = lake
    publish(spark, root, "R3", [5])
    counted = refresh.read_refreshed(spark, target)["agg_consumption_daily"].collect()
    bad = seed(spark).unionByName(seed(spark).where("job_pattern = 'Brand#12'"))
    with pytest.raises(ValueError, match="job_pattern unique"):
        refresh.refresh_marts(spark, root, bad, target)
    with monkeypatch.context() as m:
        m.setattr(M, "publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        m.setattr(refresh, "remove", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            refresh.refresh_marts(spark, root, seed(spark), target)
    assert sorted(refresh.read_refreshed(spark, target)["agg_consumption_daily"].collect()) == sorted(counted)
    assert refresh.refresh_marts(spark, root, seed(spark), target) == [("2025", "05")]
    same_as_full_build(spark, root, target)


def test_rows_without_a_date_and_reports(spark, tmp_path):
    root, target = str(tmp_path / "lake"), str(tmp_path / "marts")
    publish(spark, root, "R1", [3, None])
    with pytest.raises(ValueError, match="smf_date not_null"):
        refresh.refresh_marts(spark, root, seed(spark), target)
    with pytest.raises(ValueError, match="no marts"):
        refresh.read_refreshed(spark, target)
    assert refresh.refresh_marts(spark, root, seed(spark), target, check=False) == [("2025", "03"), (None, None)]
    same_as_full_build(spark, root, target)
    assert export_csv(refresh.read_refreshed(spark, target), str(tmp_path / "csv"), ["top_consumers"])["top_consumers"] == 1
