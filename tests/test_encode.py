"""Cost of making the test logs: what is computed once a row must not be computed inside the aggregate."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from acctlake.fixtures import encode as E
from acctlake.fixtures import trial as T
from acctlake.fixtures.specs import SPECS


def test_aggregate_collects_finished_texts(spark, sf_dir):
    plan = T.spec_records(spark, sf_dir, "smf74-2p")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"collect_list\(_e[34]#\d+, ", plan)) == 2
    assert plan.count("collect_list(") == 2


def test_small_files_of_many_rows_make_tasks_by_rows(spark, sf_dir):
    plan = T.spec_records(spark, sf_dir, "smf30")._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def test_records_are_full(spark):
    """Rows of equal values, met in any order, share a record of up to 128 entries, none of which is lost."""
    rows = spark.range(9000, numPartitions=1).selectExpr(
        "id as l_orderkey", "id % 20 as l_partkey", "id % 2 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
        "timestamp '1997-02-03' as l_shipdate", "cast(3 as double) as l_quantity", "cast(7.25 as double) as l_extendedprice",
    )
    records = E.encode(rows, SPECS["smf72-3"])
    # the count is the last word of the fifth directory entry
    counts = [r.n for r in records.select(F.conv(F.hex(F.substring("body", 22 + 4 * 12 + 9, 4)), 16, 10).cast("int").alias("n")).collect()]
    assert sum(counts) == 9000 and max(counts) == 128
    assert len(counts) <= 2 * (4096 // 2 // 128) * 2 + 2 * 7


def test_numbers_of_eight_bytes(spark):
    """All 64 bits, written without a conversion of text."""
    values = [0, 1, 4294967296, (1 << 63) - 1, 1 << 63, (1 << 64) - 1]
    rows = spark.createDataFrame([(str(v), v if v < 1 << 63 else None) for v in values], "t string, n long")
    got = rows.select("t", E.number("CAST(t AS DECIMAL(20,0))", 8).alias("d"), E.number("n", 8).alias("b")).collect()
    assert [(r.d, r.b) for r in got] == [(f"{v:016X}", f"{v:016X}" if v < 1 << 63 else None) for v in values]
    plan = T.spec_records(spark, "/root/testdata/sf0.001", "smf72-3")._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" not in plan and "typeof" not in plan


def test_rows_of_a_batch_are_collected_as_one(spark):
    """The aggregate is given a row per batch, block and record values, not one per row of the table."""
    rows = E.with_record_values(spark.range(9000, numPartitions=1).selectExpr(
        "id as l_orderkey", "id % 20 as l_partkey", "id % 2 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
        "timestamp '1997-02-03' as l_shipdate", "cast(3 as double) as l_quantity", "cast(7.25 as double) as l_extendedprice",
    ), "lineitem")
    spec = SPECS["smf74-2m"]
    parts = E.entry_parts(rows, spec, list(E.RECORD_VALUES["lineitem"])).collect()
    assert len(parts) == 2 and sum(p._rows for p in parts) == 9000
    widths = {k: sum(r.width for r in spec.sections[k]) for k in spec.repeated}
    assert all(len(p[f"_e{k}"]) == p._rows * widths[k] for p in parts for k in widths)
    # the third run of a member is its name, in the order of the rows
    names = [p._e4[i * widths[4] + 16 : i * widths[4] + 32].decode("cp037") for p in parts for i in range(2)]
    assert sorted(names) == [f"MEMBER{i}".ljust(16) for i in (0, 1, 2, 3)]


def test_octets_of_a_batch():
    def text(*values):
        return [bytes(row).decode("cp037") for row in E._text_octets(pa.array(values, pa.string()), 4)]

    assert text("AB", None, "", "LONGER", "a~[]") == ["AB  ", "    ", "    ", "LONG", "a~[]"]
    # letters outside ASCII have their place in CP037 too
    assert text("éA", "LONGER", None) == ["éA  ", "LONG", "    "]
    numbers = np.array([0, 1, 258, -1], np.int64)
    assert [bytes(row).hex() for row in E._number_octets(numbers, 2)] == ["0000", "0001", "0102", "ffff"]
    # counts of sixteenths: 0, 1/16, 1, 16 and a long one
    sixteenths = np.array([0, 1, 16, 256, 0x123456789ABCDE], np.int64)
    assert [bytes(row).hex() for row in E._hexfloat_octets(sixteenths)] == [
        "0" * 16, "4010000000000000", "4110000000000000", "4210000000000000", "4d123456789abcde",
    ]
