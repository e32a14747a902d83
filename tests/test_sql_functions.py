"""The dataset as SQL table functions: rows, columns, what is read, arguments of every kind."""

import pytest
from pyspark.sql import functions as F

from acctlake.sources import dataset as D
from acctlake.sources.sql import create_functions

TABLES = ("smf30", "smf74-1", "smf74-2p", "smf74-2m")


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Two rows a customer, month and table; the customer's name needs care in SQL."""
    path = str(tmp_path_factory.mktemp("lake"))
    for n, table in enumerate(TABLES):
        rows = spark.createDataFrame(
            [(f"S{k}", c, f"S{k}", y, m, "R1") for k in range(2) for c in ("A", "O_B") for y, m in (("2025", "03"), ("2025", "11"), (None, None))],
            "system_id string, customer string, path_system_id string, year string, month string, run_id string",
        )
        D.write_table(rows.withColumn("record_seq", F.lit(n).cast("long")), D.folder_of(path, table))
    made = create_functions(spark, path)
    assert made == ["read_smf", "read_smf30", "read_smf74", "read_smf74_1", "read_smf74_2", "read_smf74_2m", "read_smf74_2p"]
    return path


def test_rows_of_a_type_and_of_a_table(spark, root):
    for asked, tables in {"smf30": 1, "smf74": 3, "smf74-2": 2, "smf74-2p": 1, "smf99": 0}.items():
        assert spark.sql(f"SELECT * FROM read_smf('{asked}')").count() == 12 * tables
    both = spark.sql("SELECT DISTINCT table_name FROM read_smf('smf74-2')").collect()
    assert sorted(r[0] for r in both) == ["smf74-2m", "smf74-2p"]


def test_own_functions_have_the_columns_of_their_tables(spark, root):
    for name in ("smf30", "smf74-2p", "smf74"):
        got, wanted = spark.sql(f"SELECT * FROM read_{name.replace('-', '_')}()"), D.read_type(spark, root, name)
        assert got.columns == wanted.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, wanted.collect()))


@pytest.mark.parametrize("call, rows", [
    ("read_smf('smf30', customer => 'O_B')", 6),
    ("read_smf('smf30', 'A', 'S1')", 3),
    ("read_smf('smf30', year => 2025, month => 3)", 4),
    ("read_smf('smf30', month => 11)", 4),
    ("read_smf('smf30', month => NULL)", 12),
    ("read_smf('smf30', customer => 'it\\'s')", 0),
    ("read_smf(NULL)", 0),
    ("read_smf74_2(customer => 'A', system => 'S0', year => 2025, month => 11)", 2),
])
def test_folder_arguments(spark, root, call, rows):
    assert spark.sql(f"SELECT * FROM {call}").count() == rows


def test_arguments_from_another_table(spark, root):
    got = spark.sql(
        "SELECT t.name, count(*) AS n FROM VALUES ('smf30', 3), ('smf74', 11), ('none', 3) AS t(name, m), "
        "LATERAL read_smf(t.name, month => t.m) GROUP BY ALL"
    )
    assert {r.name: r.n for r in got.collect()} == {"smf30": 4, "smf74": 12}


def test_only_the_chosen_folders_are_planned(spark, root):
    chosen = spark.sql("SELECT system_id FROM read_smf('smf74-2p', customer => 'A', month => 3)")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    pushed = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "month" in pushed and "customer" in pushed
    assert "ReadSchema: struct<system_id:string>" in plan
    chosen.collect()
    nothing = spark.sql("SELECT system_id FROM read_smf('smf99')")
    assert "FileScan" not in nothing._jdf.queryExecution().executedPlan().toString()


def test_no_table(spark, tmp_path):
    with pytest.raises(ValueError, match="holds no table"):
        create_functions(spark, str(tmp_path))
