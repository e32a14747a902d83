"""The jobs as they are submitted."""

import pytest
from logs import finish, framed, header, write

from acctlake import jobs
from acctlake.sources import dataset as D


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    write(folder / "in", "a.bin", b"".join(framed(finish(header(30, 4, time=100 * i))) for i in range(7)))
    assert jobs.run(spark, ["ingest", str(folder / "in"), str(folder / "lake"), "ACME"]) == 0
    return folder


def test_ingest_reports_types(spark, lake, capsys):
    assert jobs.run(spark, ["ingest", str(lake / "in"), str(lake / "other")]) == 0
    line = next(x for x in capsys.readouterr().out.splitlines() if x.startswith("smf30"))
    assert line.split()[2:] == ["7", "records", "7", "rows"]
    assert D.read_type(spark, str(lake / "lake"), "smf30").where("customer = 'ACME'").count() == 7


def test_views_of_types_and_tables(spark, lake):
    made = D.create_views(spark, str(lake / "lake"))
    assert "smf30" in made
    assert spark.sql("select count(*) from smf30").first()[0] == 7


def test_marts_and_export(spark, lake, capsys):
    (lake / "map.csv").write_text("job_pattern,application,app_group\n*,All,Group\n")
    assert jobs.run(spark, ["marts", str(lake / "lake"), str(lake / "map.csv"), str(lake / "marts")]) == 0
    assert "fct_job_consumption" in capsys.readouterr().out
    assert jobs.run(spark, ["export", str(lake / "marts"), "--out", str(lake / "csv"), "--only", "top_consumers"]) == 0
    assert capsys.readouterr().out.split()[0] == "top_consumers"
    assert [p.name.rsplit("-", 1)[0] for p in (lake / "csv").iterdir()] == ["top_consumers"]


def test_compact(spark, lake, capsys):
    for name in ("one", "two"):
        assert jobs.run(spark, ["ingest", str(lake / "in"), str(lake / "small"), "--run-id", name]) == 0
    capsys.readouterr()
    assert jobs.run(spark, ["compact", str(lake / "small"), "2025-05", "--keep-days", "0"]) == 0
    assert capsys.readouterr().out.split() == "smf30 1 months 2 runs merged 2 folders removed".split()
    runs = D.read_type(spark, str(lake / "small"), "smf30").groupBy("run_id").count().collect()
    assert {(r.run_id, r["count"]) for r in runs} == {("one", 7), ("two", 7)}
    assert jobs.run(spark, ["compact", str(lake / "small"), "soon"]) == jobs.FAILED


def test_refresh_and_export(spark, lake, capsys):
    (lake / "map.csv").write_text("job_pattern,application,app_group\n*,All,Group\n")
    for expected in ("1 months built 0 folders removed", "0 months built 0 folders removed"):
        assert jobs.run(spark, ["refresh", str(lake / "lake"), str(lake / "map.csv"), str(lake / "monthly")]) == 0
        assert capsys.readouterr().out.strip() == expected
    assert jobs.run(spark, ["export", str(lake / "monthly"), "--out", str(lake / "csv2"), "--only", "top_consumers"]) == 0
    assert capsys.readouterr().out.split()[0] == "top_consumers"


def test_failures_have_an_exit_code(spark, lake, capsys):
    assert jobs.run(spark, ["export", str(lake / "nowhere"), "--out", str(lake / "csv")]) == jobs.FAILED
    (lake / "bad.csv").write_text("job_pattern,application,app_group\nA*,One,G\nA*,Two,G\n")
    assert jobs.run(spark, ["marts", str(lake / "lake"), str(lake / "bad.csv"), str(lake / "marts2")]) == jobs.FAILED
    assert "job_pattern unique" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        jobs.run(spark, ["nothing"])
