"""Round trips: rows -> records -> binary files -> splitter -> header -> route -> table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctlake.fixtures import encode as E
from acctlake.fixtures.specs import SPECS
from acctlake.operators import layouts as L
from acctlake.operators.decode import decode_table
from acctlake.operators.route import records_of, route
from acctlake.session import scratch_dir
from acctlake.sources.rdw import read_records

_LOGS: dict[tuple, str] = {}


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spec_records(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spec = SPECS[table]
    rows = source_table(spark, sf_dir, spec.source)
    if not spec.repeated:
        # A few compressed megabytes are millions of rows: tasks are made by the bytes of rows, not of files.
        rows = rows.hint("rebalance")
    nested = L.BY_TABLE[table].nested_in is not None
    return E.encode_nested(rows, spec) if nested else E.encode(rows, spec)


def header_only_records(spark: SparkSession, sf_dir: str, record_type: int, subtype: int) -> DataFrame:
    """Records of a bare header, the supplier key behind it."""
    rows = E.with_record_values(source_table(spark, sf_dir, "supplier"), "supplier")
    body = F.concat(E.record_header(record_type, subtype), E.number("s_suppkey", 8))
    return rows.select(E.finish(body).alias("body"))


def written_log(spark: SparkSession, key: tuple, make) -> str:
    """Folder of the binary files for a key, written once per session."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _LOGS:
        folder = scratch_dir(spark, "log")
        E.write_logs(make(), folder).count()
        _LOGS[key] = folder
    return _LOGS[key]


def table_log(spark: SparkSession, sf_dir: str, table: str) -> str:
    return written_log(spark, (sf_dir, table), lambda: spec_records(spark, sf_dir, table))


def mixed_log(spark: SparkSession, sf_dir: str) -> str:
    """One log with every typed record type, two header-only ones and an unknown type."""

    def make() -> DataFrame:
        parts = [
            # the two tables of type 74 subtype 2 share their records
            spec_records(spark, sf_dir, table) for table in SPECS if table != "smf74-2m"
        ]
        parts += [
            header_only_records(spark, sf_dir, t, s) for t, s in ((72, 1), (113, 255), (99, 1), (250, 7))
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.coalesce(8)

    return written_log(spark, (sf_dir, "mixed"), make)


def comparable(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns, with timestamps free of a zone and counter lists as text."""
    shown = []
    for name in columns:
        kind = df.schema[name].dataType.simpleString()
        column = F.col(f"`{name}`")
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind.startswith("array"):
            column = F.array_join(column.cast("array<string>"), ",")
        shown.append(column.alias(name))
    return df.select(*shown)


def _compared_columns(table: str) -> list[str]:
    skip = {"source_file", "ingest_ts", *L.LINEAGE_COLUMNS}
    return [c for c in L.columns_of(table) if c not in skip]


def table_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The rows of one table, read back from its binary log."""
    routed = route(read_records(spark, table_log(spark, sf_dir, table)))
    shown = _compared_columns(table)
    return comparable(decode_table(records_of(routed, table), table, columns=shown), *shown)


_SQL_TYPES = {"smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
              "decimal(20,0)": "DECIMAL(20,0)", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp": "TIMESTAMP", "date": "DATE"}

RECORD_TIME_SQL = "CAST(rec_date AS TIMESTAMP) + to_microseconds(CAST(rec_time AS BIGINT) * 10000)"


def source_sql(source: str) -> str:
    """The source rows with the values their record's header gets, as a subquery."""
    values = ", ".join(f"{v} AS {k}" for k, v in E.RECORD_VALUES[source].items())
    return f"(SELECT *, {values} FROM {source}) src"


def table_sql(table: str) -> str:
    """The same rows as a plain SELECT of the source values."""
    spec, kinds = SPECS[table], L.columns_of(table)
    values = {
        "smf_timestamp": RECORD_TIME_SQL,
        "smf_date": "rec_date",
        "system_id": "rec_system",
        "subsystem_id": "''" if spec.record_type == 1154 else "'JES2'",
        "record_type": str(spec.record_type),
        "subtype": str(spec.subtype),
        "flags": "0",
        "interval_start_ts": RECORD_TIME_SQL,
        "interval_ms": "rec_interval * 10",
        "sample_count": "rec_samples",
        "sysplex_name": "rec_plex",
    }
    values |= {run.name: run.sql() for run in spec.runs(L.BY_TABLE[table].rows)} | dict(spec.extra)
    if table == "smf113":
        counters = ("CAST(18446744073709551615 AS DECIMAL(20,0)) - p_partkey", "p_partkey",
                    "CAST(round(p_retailprice * 100) AS BIGINT)", "p_size")
        listed = ", ".join(f"CAST(CAST({c} AS DECIMAL(20,0)) AS VARCHAR)" for c in counters)
        values["counters"] = f"array_to_string(([{listed}])[1:1 + p_size % 4], ',')"
        kinds = kinds | {"counters": "string"}
    shown = ", ".join(
        f"CAST({values[c]} AS {_SQL_TYPES[kinds[c]]}) AS {c}" for c in _compared_columns(table)
    )
    where = " WHERE l_linenumber <= 3" if table == "smf73-1" else ""
    return f"SELECT {shown} FROM {source_sql(spec.source)}{where}"
