"""Mapping, checks, exports and readers beyond what the SQL comparison covers."""

import datetime as dt
import itertools
import re
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from acctlake.fixtures.accounts import acct, seed
from acctlake.operators import checks, mapping
from acctlake.plans import marts, reports
from acctlake.session import SHUFFLE_CLEANUP
from acctlake.sources import dataset as D
from acctlake.streaming.incremental import ingest_stream, latest_copies
from logs import finish, framed, header, write


def like(name: str, pattern: str) -> bool:
    if not pattern:
        return not name
    if pattern[0] in "*%":
        return any(like(name[i:], pattern[1:]) for i in range(len(name) + 1))
    return bool(name) and pattern[0] in ("_", name[0]) and like(name[1:], pattern[1:])


def test_pattern_matches_against_brute_force(spark):
    names = ["".join(x) for n in range(4) for x in itertools.product("AB_", repeat=n)] + ["A\\B", "CICSPROD"]
    patterns = ["*", "", "A*", "*B", "*AB*", "_", "A_B", "%A", "**", "*A*B*", "A\\B", "CICS*", "CICSPROD", "__"]
    got = mapping.pattern_matches(
        spark.createDataFrame([(n,) for n in names], "job_name string"),
        spark.createDataFrame([(p, "x", "y") for p in patterns], "job_pattern string, application string, app_group string"),
    ).select("job_name", "job_pattern").collect()
    assert sorted((r.job_name, r.job_pattern) for r in got) == sorted(
        (n, p) for n in names for p in patterns if like(n, p)
    )


def test_no_nested_loop_in_the_dimension(spark, sf_dir):
    dim = mapping.dim_application(acct(spark, sf_dir), seed(spark))
    plan = dim._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_known_jobs_resolve(spark, sf_dir):
    dim = mapping.dim_application(acct(spark, sf_dir), seed(spark))
    found = {r.job_name: r.application for r in dim.select("job_name", "application").distinct().collect()}
    assert found["Brand#12"] == "Payroll" and found["Brand#11"] == "Billing"
    assert found["Brand#20"] == "Reporting"  # equal lengths: the smaller text
    assert found[""] == mapping.UNMAPPED


def test_checks_find_failures(spark):
    bad = spark.createDataFrame(
        [("a|x", "x", "App"), ("a|x", "x", None)], "app_key string, job_name string, application string"
    )
    found = {(r.column_name, r.check): r.failures for r in checks.run_checks({"dim_application": bad}).collect()}
    assert found == {("job_name", "not_null"): 0, ("application", "not_null"): 1,
                     ("app_key", "not_null"): 0, ("app_key", "unique"): 1}
    with pytest.raises(ValueError, match="app_key unique: 1"):
        checks.assert_checks({"dim_application": bad})


def test_csv_export(spark, sf_dir, tmp_path):
    models = marts.define_marts(acct(spark, sf_dir), seed(spark))
    day = dt.date(2026, 3, 4)
    written = reports.export_csv(models, str(tmp_path), only=["top_consumers"], day=day, single_file=True)
    assert written == {"top_consumers": 100}
    (part,) = (tmp_path / "top_consumers-20260304").glob("*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == "customer,application,job_name,program_name,runs,total_cpu_sec,total_excp"
    assert len(lines) == 101
    with pytest.raises(ValueError):
        reports.export_csv(models, str(tmp_path), only=["no_such_report"])


def test_unknown_dimension_is_refused(spark, sf_dir):
    with pytest.raises(ValueError, match="no such column: colour"):
        reports.metric_by_dimension(acct(spark, sf_dir), "colour")


def test_nested_layout_with_growing_schema(spark, tmp_path):
    def put(customer, system, year, month, name, **columns):
        folder = tmp_path / customer / system / f"year={year}" / f"month={month}"
        folder.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(columns), folder / name)

    put("ACME", "SYS1", "2025", "04", "SMF30-20250410-R1.parquet", job_name=["A"], excp_count=pa.array([1], pa.uint32()))
    put("ACME", "SYS2", "2025", "05", "SMF30-20250511-R1.parquet", job_name=["B"], excp_count=pa.array([2], pa.uint32()), extra=[5])
    put("MY CO", "0001", "null", "null", "SMF30-null-R2.parquet", job_name=["C"], excp_count=pa.array([2**32 - 1], pa.uint32()))
    put("ACME", "SYS1", "2025", "04", "SMF70-1-20250410-R1.parquet", other=[1])
    rows = D.read_nested(spark, str(tmp_path), "SMF30").orderBy("job_name").collect()
    assert [(r.customer, r.path_system_id, r.year, r.month, r.excp_count, r.extra) for r in rows] == [
        ("ACME", "SYS1", 2025, 4, 1, None), ("ACME", "SYS2", 2025, 5, 2, 5),
        ("MY CO", "0001", None, None, 4294967295, None)]
    assert "other" not in rows[0].asDict()


def test_stream_takes_each_file_once_and_copies_are_recognised(spark, tmp_path):
    inbox, root, state = tmp_path / "inbox", str(tmp_path / "lake"), str(tmp_path / "state")
    one = b"".join(framed(finish(header(30, 4, time=t))) for t in (100, 200))

    def arrive(name, data):
        write(inbox, name, data)
        ingest_stream(spark, str(inbox), root, state).awaitTermination()
        return D.read_type(spark, root, "smf30")

    assert arrive("a.bin", one).count() == 2
    assert arrive("b.bin", framed(finish(header(30, 4, time=300)))).count() == 3
    again = arrive("copy-of-a.bin", one)
    assert again.count() == 5
    assert latest_copies(again, D.read_files(spark, root)).count() == 3


def test_late_and_straddling_rows_go_to_their_own_month(spark, tmp_path):
    inbox, root, state = tmp_path / "inbox", str(tmp_path / "lake"), str(tmp_path / "state")
    for name, days in (("on-time.bin", (120, 121)), ("late.bin", (119, 90))):
        write(inbox, name, b"".join(framed(finish(header(30, 4, day=d))) for d in days))
        ingest_stream(spark, str(inbox), root, state).awaitTermination()
    months = D.read_type(spark, root, "smf30").groupBy("year", "month").count().collect()
    assert {(r.year, r.month, r["count"]) for r in months} == {
        ("2025", "03", 1), ("2025", "04", 2), ("2025", "05", 1)}


def test_files_from_before_a_column_was_added(spark, tmp_path):
    folder = tmp_path / "smf30" / "customer=0007" / "path_system_id=0001" / "year=2025" / "month=04" / "run_id=R0"
    folder.mkdir(parents=True)
    pq.write_table(pa.table({"job_name": ["A"], "excp_count": pa.array([1], pa.int64())}), folder / "a.parquet")
    newer = folder.parent / "run_id=R1"
    newer.mkdir()
    pq.write_table(pa.table({"job_name": ["B"], "invented_later": [3]}), newer / "b.parquet")
    rows = D.read_type(spark, str(tmp_path), "smf30").orderBy("job_name").collect()
    assert [(r.job_name, r.excp_count, r.step_name, r.customer, r.path_system_id) for r in rows] == [
        ("A", 1, None, "0007", "0001"), ("B", None, None, "0007", "0001")]
    wide = D.read_type(spark, str(tmp_path), "smf30", merge_schema=True).orderBy("job_name").collect()
    assert [(r.job_name, r.invented_later, r.customer, r.month) for r in wide] == [
        ("A", None, "0007", "04"), ("B", 3, "0007", "04")]


def test_chosen_folders_are_the_only_ones_listed(spark, tmp_path):
    for customer, year, month in (("A", "2024", "01"), ("A", "2024", "12"), ("A", "2025", "01"), ("B{1}", "2024", "01")):
        folder = tmp_path / "smf30" / f"customer={customer}" / "path_system_id=S" / f"year={year}" / f"month={month}" / "run_id=R"
        folder.mkdir(parents=True)
        pq.write_table(pa.table({"job_name": [f"{customer}{year}{month}"]}), folder / "a.parquet")

    def names(**chosen):
        rows = D.read_table(spark, str(tmp_path), "smf30", **chosen)
        found = sorted(r.job_name for r in rows.collect())
        assert len(rows.inputFiles()) == len(found)
        return found

    assert names(year=2024) == ["A202401", "A202412", "B{1}202401"]
    assert names(customer="A", month=1) == ["A202401", "A202501"]
    assert names(customer="B{1}") == ["B{1}202401"]
    assert names(customer="B*") == names(year=1999) == []
    assert D.read_type(spark, str(tmp_path), "smf30", customer="A", year=2025).first().month == "01"


def test_dataset_root_comes_from_the_session(spark, tmp_path):
    with pytest.raises(ValueError, match="no dataset root"):
        D.default_root(spark)
    spark.conf.set(D.ROOT_SETTING, str(tmp_path))
    assert D.default_root(spark) == str(tmp_path)
    assert D.default_root(spark, "/elsewhere/") == "/elsewhere"
    spark.conf.unset(D.ROOT_SETTING)


def test_drill_into_a_filtered_part(spark, sf_dir):
    fct = marts.define_marts(acct(spark, sf_dir), seed(spark))["fct_job_consumption"]
    whole = reports.drill(fct, ["customer"]).where("customer = 'NATION_3'").first()
    part = reports.drill(fct, ["system_id"], customer="NATION_3").collect()
    assert sum(r.step_runs for r in part) == whole.step_runs


def test_build_marts_twice(spark, sf_dir, tmp_path):
    for _ in range(2):
        built = marts.build_marts(spark, acct(spark, sf_dir), seed(spark), str(tmp_path))
    assert built["fct_job_consumption"].count() == acct(spark, sf_dir).count()
    with pytest.raises(ValueError, match="app_key|job_pattern"):
        doubled = seed(spark).unionByName(seed(spark))
        marts.build_marts(spark, acct(spark, sf_dir), doubled, str(tmp_path / "bad"))


def test_a_failed_check_leaves_the_last_build(spark, sf_dir, tmp_path):
    target = str(tmp_path / "marts")
    marts.build_marts(spark, acct(spark, sf_dir), seed(spark), target)
    before = marts.read_marts(spark, target)["dim_application"].count()
    with pytest.raises(ValueError, match="job_pattern"):
        marts.build_marts(spark, acct(spark, sf_dir), seed(spark).unionByName(seed(spark)), target)
    again = marts.read_marts(spark, target)
    assert again["dim_application"].count() == before
    assert len([p for p in (tmp_path / "marts").iterdir() if p.name.startswith("build-")]) == 1
    fact = again["fct_job_consumption"]
    assert "PartitionFilters: [isnotnull(year" in fact.where("year = 1996")._jdf.queryExecution().toString()
    assert fact.where("year = 1996").count() == acct(spark, sf_dir).where("year = 1996").count()


def test_a_reader_of_the_last_build_ends_after_the_next(spark, sf_dir, tmp_path):
    target = tmp_path / "marts"
    few = acct(spark, sf_dir).where("year = 1996 and month = 3")

    def build():
        marts.build_marts(spark, few, seed(spark), str(target), check=False)
        return marts.read_marts(spark, str(target))["fct_job_consumption"], marts.current_build(str(target))

    rows = few.count()
    (first, a), (second, b) = build(), build()
    assert first.count() == second.count() == rows
    _, c = build()
    assert second.count() == rows
    assert {p.name for p in target.iterdir() if p.name.startswith("build-")} == {b, c} and a not in (b, c)


def test_nothing_built(spark, tmp_path):
    with pytest.raises(ValueError, match="no marts"):
        marts.read_marts(spark, str(tmp_path))


def joined_then_summed(plan):
    """Whether a sort-merge join feeds an aggregate without an exchange between."""
    lines, wrong = plan.splitlines(), False
    for n, line in enumerate(lines):
        if "SortMergeJoin" in line:
            for above in reversed(lines[:n]):
                if "Exchange" in above:
                    break
                wrong |= "HashAggregate" in above and above.index("HashAggregate") < line.index("SortMergeJoin")
    return wrong


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_hot_jobs_are_added_up_before_the_join(spark, sf_dir, depth):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        planned = marts.define_marts(
            spark.createDataFrame(acct(spark, sf_dir).limit(50).collect(), acct(spark, sf_dir).schema), seed(spark)
        )
        rows, dim = marts.job_rows(planned)
        report = reports.drill(rows, reports.DRILL_PATH[:depth], dim=dim)
        top = reports.top_consumers(planned)
        for df in (report, top):
            text = df._jdf.queryExecution().sparkPlan().toString()
            joins = [i for i, x in enumerate(text.splitlines()) if "Join" in x and "LeftOuter" in x]
            below = "\n".join(text.splitlines()[joins[0]:]) if joins else "Aggregate"
            assert "Aggregate" in below
        fact = planned["fct_job_consumption"]
        assert sorted(map(str, report.collect())) == sorted(map(str, reports.drill(fact, reports.DRILL_PATH[:depth]).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_heavy_input_is_planned_at_most_twice(spark, sf_dir):
    models = marts.define_marts(acct(spark, sf_dir), seed(spark))

    def scans(df):
        return df._jdf.queryExecution().sparkPlan().toString().count("lineitem.parquet")

    assert scans(models["fct_job_consumption"]) <= 2
    assert scans(models["dim_application"]) == 1
    assert scans(checks.check_model("dim_application", models["dim_application"])) == 1
    assert scans(reports.metric_by_dimension(models["agg_consumption_daily"])) == 0  # totals are a written table


def test_missing_names_have_a_label(spark):
    row = acct_row(job_name=None, program_name=None)
    frame = spark.createDataFrame([row, acct_row(job_name="", program_name="")])
    from acctlake.plans import queries

    shown = queries.jobs_per_date(frame.drop("subsystem_id")).collect()
    assert {(r.job_name, r.program_name) for r in shown} == {("(no job name)", "(none)")}
    models = marts.define_marts(frame, seed(spark))
    report = models["rpt_jobs_by_date"].collect()
    assert {(r.job_label, r.program_name, r.application) for r in report} == {("(no job name)", "(none)", mapping.UNMAPPED)}
    assert sum(r.step_runs for r in report) == 2


def acct_row(**more):
    day = dt.date(2024, 2, 3)
    return {
        "customer": "C", "job_name": "J", "step_name": "S", "job_id": "JOB1", "program_name": "P",
        "smf_timestamp": dt.datetime(2024, 2, 3), "smf_date": day, "system_id": "SYS1", "subsystem_id": "JES2",
        "cpu_sec": 1.0, "tcb_sec": 1.0, "srb_sec": 0.5, "ziip_sec": 0.0, "elapsed_sec": 2.0, "excp_count": 3,
        "year": 2024, "month": 2, "source_file": "f", **more,
    }


def test_reports_are_in_order(spark, sf_dir):
    from acctlake.plans import queries

    jobs = acct(spark, sf_dir)
    models = marts.define_marts(jobs, seed(spark))

    def key(row, *columns):
        # (column, descending): missing values last either way
        return tuple((row[c] is None, (-row[c] if down else row[c]) if row[c] is not None else 0) for c, down in columns)

    day, cpu, system, job = ("smf_date", False), ("cpu_sec", True), ("system_id", False), ("job_name", False)
    for report, order in (
        (reports.jobs_by_date(models), (day, system, cpu)),
        (reports.consumption_daily(models), (day, cpu)),
        (reports.consumption_by_application(models), (cpu,)),
        (reports.drill(models["fct_job_consumption"]), (cpu,)),
        (queries.coverage(jobs), (day, system)),
    ):
        rows = [key(r, *order) for r in report.collect()]
        assert len(rows) > 1 and rows == sorted(rows)


def test_long_paths_are_searched_in_linear_time(spark):
    # Names without a slash, as long as a path may be: a search from each of their letters took minutes for these rows.
    shown = ["customer=MY%20CO/path_system_id=0001/year=2025/month=04/", "=A/b=/year=null/month=null/", "a=b=c/S/year=1/month=2/", "year=2025/"]
    paths = [f"file:/{'x' * 4000}/{'y' * 4000}/{rest}r.parquet" for rest in shown]
    rows = spark.createDataFrame(list(enumerate(paths)), "id int, path string").join(spark.range(0, 500, 1, 8).toDF("copy"))
    start = time.monotonic()
    parts = rows.select("id", D.path_parts(F.col("path")).alias("parts"))
    found = parts.select("id", *[v.alias(k) for k, v in D.path_dimensions(F.col("parts")).items()]).distinct().collect()
    assert time.monotonic() - start < 30
    assert sorted(map(tuple, found)) == [
        (0, "MY CO", "0001", 2025, 4), (1, "=A", "b=", None, None), (2, "b=c", "S", 1, 2), (3, "", "", None, None)]


def test_a_build_works_its_input_out_once(spark, sf_dir, tmp_path):
    """The input may be a join of large tables; the dimension, the fact and the checks read what was written of it."""
    seen = spark.sparkContext.accumulator(0)

    def counted(name):
        seen.add(1)
        return name

    rows = acct(spark, sf_dir)
    n = rows.count()
    built = marts.build_marts(spark, rows.withColumn("customer", F.udf(counted)("customer")), seed(spark), str(tmp_path / "marts"))
    assert seen.value == n
    assert built["fct_job_consumption"].count() == n
    assert not list((tmp_path / "marts").glob("build-*/stg_smf30"))


def test_a_build_leaves_no_shuffle_files(spark, sf_dir, tmp_path):
    """Builds in one session would else add up on the executors' disks."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_\d+", blocks.getAllFiles().mkString(" ")))

    before = shuffles()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marts.build_marts(spark, acct(spark, sf_dir), seed(spark), str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    deadline = time.monotonic() + 20  # files are removed a moment later
    while shuffles() - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) in (None, "false")


def test_rows_of_lineitem_do_not_meet_customers(spark, sf_dir):
    """The largest table is shuffled for its orders and parts only."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = acct(spark, sf_dir, narrow=True)._jdf.queryExecution().sparkPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    (at,) = [n for n, x in enumerate(lines) if "Join" in x and "c_custkey" in x]
    end = next((n for n in range(at + 1, len(lines)) if depth[n] <= depth[at]), len(lines))
    below = "\n".join(lines[at:end])
    assert "customer.parquet" in below and "lineitem.parquet" not in below


def test_alike_rows_stand_together(spark):
    rows = [acct_row(job_name=f"J{n % 7}", program_name=None if n % 3 else "P", cpu_sec=float(n)) for n in range(400)]
    staged = marts.stg_smf30(spark.createDataFrame(rows).coalesce(1))
    seen = [(r.job_name, r.program_name) for r in staged.sortWithinPartitions(marts.alike(staged.columns)).collect()]
    assert len(seen) == 400 and len([k for k, _ in itertools.groupby(seen)]) == 14
