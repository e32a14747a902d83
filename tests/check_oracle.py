"""Run registered queries next to their SQL and compare rows: ``python tests/check_oracle.py [dir] [names]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def compare(df, con, sql: str):
    """None if both give the same columns and rows, else a text that says how they differ."""
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    con.execute(sql)
    names = [d[0] for d in con.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    picks = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in picks) for row in con.fetchall())
    if got == expected:
        return None
    return (
        f"{sum(got.values())} and {sum(expected.values())} rows; only here "
        f"{list((got - expected))[:2]}; only there {list((expected - got))[:2]}"
    )


def main() -> int:
    from acctlake.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "check",
        **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "10g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        if name not in oracles:
            print(f"none {name}", flush=True)
            continue
        began = time.time()
        try:
            problem = compare(query(spark, sf_dir), con, oracles[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}",
              flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
