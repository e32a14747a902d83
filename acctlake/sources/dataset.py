"""The record dataset: one folder per table, partitioned by customer, system, year and month.

``<root>/<table>/customer=…/path_system_id=…/year=…/month=…/run_id=…/*.parquet``; header-only tables
share ``<root>/header_only/table_name=…/…``. Publishing is append-only: a run only ever adds files
under its own ``run_id``, so a run that is repeated after a failure replaces exactly what it wrote
before. ``system_id`` stays a column in the files; the directory carries its sanitised form.
Closed months can be merged into few files (:mod:`acctlake.sources.compaction`); readers follow the table's manifest.
"""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctlake.functions.text import date_parts, sanitize
from acctlake.operators import layouts as L
from acctlake.sources import manifest as M
from acctlake.sources.files import locate

PARTITIONS = ("customer", "path_system_id", "year", "month", "run_id")
HEADER_ONLY = "header_only"
#: Beside the tables: damaged frames, and the accounts of every run by table and by input file.
MALFORMED, AUDIT, FILES = "malformed", "audit", "files"
FILES_SCHEMA = "ingest_ts timestamp, source_file string, file_hash string, records bigint, run_id string"
AUDIT_SCHEMA = (
    "ingest_ts timestamp, table_name string, disposition string, records bigint, rows bigint, "
    "run_id string"
)
MALFORMED_SCHEMA = (
    "source_file string, record_seq bigint, byte_offset bigint, error string, body binary, "
    "file_hash string, ingest_ts timestamp, run_id string"
)
ROOT_SETTING = "spark.acctlake.root"

#: One view per record type; a view covers the tables of all its subtypes.
VIEW_TYPES = tuple(f"smf{t}" for t in L.KNOWN_TYPES)


def default_root(spark: SparkSession, root: str | None = None) -> str:
    """The dataset root: the argument, else the session setting."""
    found = root or spark.conf.get(ROOT_SETTING, None)
    if not found:
        raise ValueError(f"no dataset root: pass one or set {ROOT_SETTING}")
    return found.rstrip("/")


# -- writing -------------------------------------------------------------------------------------


def with_partitions(rows: DataFrame, customer: Column) -> DataFrame:
    """Add the directory columns. A row without a believable date has no year and no month."""
    parts = date_parts(F.col("smf_date"))
    return rows.select(
        "*",
        sanitize(customer).alias("customer"),
        sanitize(F.col("system_id")).alias("path_system_id"),
        parts["year"].alias("year"),
        parts["month"].alias("month"),
    )


def dataset_path(customer: Column, system_id: Column, date: Column, table: Column,
                 run_id: Column) -> Column:
    """Path of a file in the nested layout of :func:`read_nested`."""
    parts = date_parts(date)
    return F.concat(
        sanitize(customer), F.lit("/"), sanitize(system_id),
        F.lit("/year="), F.coalesce(parts["year"], F.lit("null")),
        F.lit("/month="), F.coalesce(parts["month"], F.lit("null")), F.lit("/"),
        F.upper(table), F.lit("-"), F.coalesce(parts["day_text"], F.lit("null")), F.lit("-"), run_id,
        F.lit(".parquet"),
    )


def write_table(rows: DataFrame, path: str, by_table: bool = False) -> None:
    """Publish rows that carry the directory columns.

    No shuffle here: :func:`clustered` input already brings few directories to each task.
    """
    keys = (("table_name",) if by_table else ()) + PARTITIONS
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*keys)
        .parquet(path)
    )


def clustered(rows: DataFrame, *keys: str) -> DataFrame:
    """Bring rows of equal keys together in tasks of even size.

    A rebalance, not a repartition: a key that holds a third of all rows is spread over as many
    tasks as its bytes ask for, and small keys share one.
    """
    return rows.hint("rebalance", *[F.col(k) for k in keys])


# -- reading -------------------------------------------------------------------------------------


def _folders(path: str) -> list[str]:
    filesystem, inner = locate(path)
    infos = filesystem.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
    return sorted(i.base_name for i in infos if i.type == pafs.FileType.Directory)


def tables_present(root: str) -> dict[str, str]:
    """Table name to kind (typed, header_only, raw) for what the dataset holds."""
    found = {}
    for name in _folders(root):
        if name in L.BY_TABLE:
            found[name] = "typed"
        elif name == "raw":
            found[name] = "raw"
    for name in _folders(f"{root}/{HEADER_ONLY}"):
        if name.startswith("table_name="):
            found[name.removeprefix("table_name=")] = HEADER_ONLY
    return found


def folder_of(root: str, table: str) -> str:
    """The folder below which a table is partitioned; header-only tables share one."""
    return f"{root}/{HEADER_ONLY}" if table not in L.BY_TABLE and table != "raw" else f"{root}/{table}"


def table_path(root: str, table: str) -> str:
    """The folder of a table's customers."""
    folder = folder_of(root, table)
    return f"{folder}/table_name={table}" if folder.endswith(f"/{HEADER_ONLY}") else folder


def _stored_schema(table: str, by_table: bool, merged: bool = False) -> str:
    columns = [
        f"`{n}` {k}" for n, k in L.columns_of(table).items() if n not in PARTITIONS
    ] + [f"{M.ORIGIN} string"] * merged + [f"{p} string" for p in PARTITIONS]
    if by_table:
        columns.append("table_name string")
    return ", ".join(columns)


def _folder(value: str | int | None, key: str) -> str:
    """The folder of a value, or a pattern for all of them."""
    if value is None:
        return f"{key}=*"
    text = f"{value:02d}" if isinstance(value, int) else value
    # characters that mean something in a pattern stand for themselves
    return f"{key}=" + "".join(f"\\{c}" if c in "*?[]{}\\" else c for c in text)


def read_table(spark: SparkSession, root: str, table: str, merge_schema: bool = False,
               customer: str | None = None, system: str | None = None,
               year: int | None = None, month: int | None = None) -> DataFrame:
    """One table across customers, systems, months and runs.

    The known schema is used: files from before a column was added read as NULL there, no footer is
    opened to plan the query, and filters on the directory columns prune folders.
    ``merge_schema`` looks at every file instead, to see columns this version does not know.

    A filter prunes after all folders were listed. ``customer``, ``system``, ``year`` and ``month`` (as the folders are
    named) choose folders before that: only the chosen ones are listed. No such folder gives no rows.

    Of compacted months the merged rows are read, and show the run that they came from; the manifest is taken first and the
    folders are listed after, so the rows are those of one version.
    """
    by_table = table not in L.BY_TABLE and table != "raw"
    known = M.read(spark, root, table)
    path = folder_of(root, table)
    chosen = {"customer": customer, "path_system_id": system, "year": year, "month": month}
    reader = spark.read
    if any(v is not None for v in chosen.values()):
        base, parts = path, [f"table_name={table}"] if by_table else []
        parts += [_folder(v, k) for k, v in chosen.items()]
        while parts[-1].endswith("=*"):
            parts.pop()
        path = "/".join([base, *parts])
        if not _any_match(spark, path):
            rows = spark.createDataFrame([], _stored_schema(table, by_table))
            return rows.drop("table_name") if by_table else rows
        reader = reader.option("basePath", base)
    if merge_schema:
        found = reader.option("mergeSchema", True).parquet(path).schema
        # directory names stay text, whatever they look like
        names = (*PARTITIONS, "table_name")
        kept = T.StructType(
            [T.StructField(f.name, T.StringType()) if f.name in names else f for f in found]
        )
        rows = reader.schema(kept).parquet(path)
    else:
        rows = reader.schema(_stored_schema(table, by_table, bool(known.months))).parquet(path)
    rows = rows.where(known.visible())
    if M.ORIGIN in rows.columns:
        rows = rows.withColumn("run_id", F.coalesce(M.ORIGIN, "run_id")).drop(M.ORIGIN)
    if by_table:
        rows = rows.where(F.col("table_name") == table).drop("table_name")
    return rows


def read_folders(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All folders of a table as they are, whether they count or not, with ``origin_run`` of merged rows and, for
    header-only tables, ``table_name``."""
    by_table = table not in L.BY_TABLE and table != "raw"
    rows = spark.read.schema(_stored_schema(table, by_table, merged=True)).parquet(folder_of(root, table))
    return rows.where(F.col("table_name") == table) if by_table else rows


def _any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a folder pattern matches anything, asked of the file system that Spark reads from."""
    return bool(M.matching(spark, pattern))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """Per run and table: what became of the records, how many there were, how many rows they gave."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(f"{root}/{AUDIT}")


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """Per run and input file: its content hash and how many records were read."""
    return spark.read.schema(FILES_SCHEMA).parquet(f"{root}/{FILES}")


def read_malformed(spark: SparkSession, root: str) -> DataFrame:
    """Frames that could not be used: where they are, what was wrong, and their bytes if any."""
    return spark.read.schema(MALFORMED_SCHEMA).parquet(f"{root}/{MALFORMED}")


def read_type(spark: SparkSession, root: str | None, record_type: str,
              merge_schema: bool = False, **folders) -> DataFrame:
    """All rows of a record type (``smf30``, ``smf74``, ``raw``): its subtype tables united by name.

    A full table name (``smf74-1``) reads just that table. ``folders`` are the choices of :func:`read_table`.
    """
    root = default_root(spark, root)
    present = tables_present(root)
    wanted = [t for t in present if t == record_type or t.startswith(f"{record_type}-")]
    # 74-2 has two tables, named after what they hold
    if not wanted:
        wanted = [t for t in present if t.rstrip("pm") == record_type]
    if not wanted:
        raise ValueError(f"the dataset has no rows of {record_type}")
    return union_by_name([read_table(spark, root, t, merge_schema, **folders) for t in wanted])


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts under the columns of any of them; missing values are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def create_views(spark: SparkSession, root: str | None = None) -> list[str]:
    """A temporary view per record type and one per table of the dataset (``smf74-2p`` is written with backquotes in
    SQL); returns their names."""
    root = default_root(spark, root)
    present = tables_present(root)
    made = []
    for view in (*VIEW_TYPES, "raw"):
        if any(t == view or t.startswith(f"{view}-") for t in present):
            read_type(spark, root, view).createOrReplaceTempView(view)
            made.append(view)
    for table in sorted(t for t in present if t in L.BY_TABLE and t not in made):
        read_table(spark, root, table).createOrReplaceTempView(f"`{table}`")
        made.append(table)
    return made


#: Customer, system, year and month as they stand in a file path, with or without ``key=``. Names are whole (possessive) and begin at
#: a slash: a search from each letter, with all ways back, costs the square of the path.
PATH_PATTERN = r"(?:^|/)([^/]++/[^/]++/year=[^/]++/month=[^/]++)/"


def path_parts(path: Column) -> Column:
    """The four parts of a file path that :func:`path_dimensions` reads, as an array; [''] where it has none."""
    return F.split(F.regexp_extract(F.url_decode(path), PATH_PATTERN, 1), "/")


def path_dimensions(parts: Column) -> dict[str, Column]:
    """Customer, system, year and month out of :func:`path_parts`; '' or NULL where the path has none."""

    def part(i: int) -> Column:
        return F.coalesce(F.get(parts, F.lit(i)), F.lit(""))

    def value(i: int) -> Column:
        return F.regexp_extract(part(i), "^(?:[^=]++=)?([^/]++)$", 1)

    return {
        "customer": value(0),
        "path_system_id": value(1),
        "year": F.substring(part(2), 6, 1 << 30).try_cast("int"),
        "month": F.substring(part(3), 7, 1 << 30).try_cast("int"),
    }


def read_nested(spark: SparkSession, root: str, type_prefix: str) -> DataFrame:
    """Rows of a type from the nested layout that Spark cannot discover by itself:
    ``<root>/<customer>/<system>/year=…/month=…/<TYPE>-<day>-<run>.parquet``.

    Files are chosen by name; columns are united by name over all of them.
    """
    rows = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"{type_prefix}-*.parquet")
        .option("mergeSchema", "true")
        .parquet(root)
    )
    path = F.col("_metadata.file_path")
    dims = path_dimensions(F.col("parts__path"))
    stored = [c for c in rows.columns if c not in dims and c != "filename"]
    # The path is searched once a row, and all four values are read from what was found.
    return rows.select("*", path.alias("path__path"), path_parts(path).alias("parts__path")).select(
        *[value.alias(name) for name, value in dims.items()], F.col("path__path").alias("filename"), *stored
    )
