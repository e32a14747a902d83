"""The dataset as SQL table functions.

``create_functions(spark, root)`` makes, for the session:

* ``read_smf(record_type, customer, system, year, month)``: all rows of a record type (``'smf74'``) or of one table
  (``'smf74-2p'``); all arguments but the first may be left out. A SQL function has one result, so it has the columns of every
  table that the dataset holds, ``table_name`` first; those that the type does not have are NULL.
* one function per table and record type with just its own columns, named after it: ``read_smf30(...)``, ``read_smf74(...)``,
  ``read_smf74_2p(...)``, ``read_raw(...)``, with the same folder arguments::

    SELECT system_id, count(*) FROM read_smf('smf74-2p', month => 4) GROUP BY ALL
    SELECT * FROM read_smf74_2p(customer => 'ACME', year => 2025)

A function is a query that Spark puts in place of the call. Given as literals, a type leaves the scans of its tables only and folder
arguments become partition filters, so neither is opened just to be dropped. Arguments that are not literals are right, too, but are
decided row by row. A type that the dataset does not have gives no rows. A NULL argument is one left out.

The functions see the tables and the manifests as they were when the functions were made: make them anew after compaction or when a
table is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.sources.dataset import VIEW_TYPES, default_root, read_table, tables_present, union_by_name

FUNCTION = "read_smf"
#: Folder arguments: name, type and the directory column that each chooses; month is written with two digits there.
FOLDERS = (("customer", "STRING", "customer"), ("system", "STRING", "path_system_id"),
           ("year", "INT", "year"), ("month", "INT", "month"))
#: Rows below the functions; a view of its own so that a temporary function can name it.
VIEW = "read_smf__rows"


def types_of(table: str) -> list[str]:
    """The names under which a table's rows are asked for: its own and that of its record type."""
    found = {table}
    for name in (*VIEW_TYPES, "raw"):
        # 74-2 has two tables, named after what they hold
        if table == name or table.startswith(f"{name}-"):
            found |= {name, table.rstrip("pm")}
    return sorted(found)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _chosen(function: str) -> str:
    """The condition of the folder arguments; arguments carry the function's name, which columns do not."""
    parts = []
    for name, kind, column in FOLDERS:
        given = f"{function}.{name}"
        # Text of the directory against text of the argument: a cast of the column would not prune.
        folder = given if kind == "STRING" else f"lpad(CAST({given} AS STRING), {2 if name == 'month' else 4}, '0')"
        parts.append(f"({given} IS NULL OR {column} = {folder})")
    return " AND ".join(parts)


def _create(spark: SparkSession, function: str, rows: DataFrame, by_type: bool) -> None:
    view = f"{VIEW}_{function}"
    rows.createOrReplaceTempView(view)
    hidden = ["asked__as"] if by_type else []
    columns = [c for c in rows.columns if c not in hidden]
    arguments = ["record_type STRING"] * by_type + [f"{n} {k} DEFAULT NULL" for n, k, _ in FOLDERS]
    returned = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in hidden)
    where = _chosen(function)
    if by_type:
        where = f"array_contains(asked__as, {function}.record_type) AND {where}"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {function}({', '.join(arguments)}) RETURNS TABLE({returned}) "
        f"RETURN SELECT {', '.join(f'{view}.`{c}`' for c in columns)} FROM {view} WHERE {where}"
    )


def create_functions(spark: SparkSession, root: str | None = None) -> list[str]:
    """The table functions of a dataset for this session; returns their names."""
    root = default_root(spark, root)
    tables = {t: read_table(spark, root, t) for t in sorted(tables_present(root))}
    if not tables:
        raise ValueError(f"{root} holds no table")
    named: dict[str, list[str]] = {}
    for table in tables:
        for name in types_of(table):
            named.setdefault(name, []).append(table)
    made = [FUNCTION]
    asked = {t: F.array(*[F.lit(n) for n in types_of(t)]) for t in tables}
    _create(spark, FUNCTION, union_by_name([
        rows.select(F.lit(t).alias("table_name"), "*", asked[t].alias("asked__as")) for t, rows in tables.items()
    ]), by_type=True)
    for name, members in sorted(named.items()):
        function = f"read_{name.replace('-', '_')}"
        _create(spark, function, union_by_name([tables[t] for t in members]), by_type=False)
        made.append(function)
    return made
