"""Sinks (W1–W5): Parquet, CSV, catalog tables and stable-name views.

The spreadsheet writer of the register tool is not built (single-machine
format with a row cap, ledger L29)."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fixreg.session import remove_path

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv")
CANCELLED = "cancelled, as another table failed"


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: list[str] | None = None,
                  balanced: bool = False, max_rows_per_file: int | None = None, changed_only: bool = False) -> None:
    """W1.

    ``balanced`` deals the rows out anew before the write, by ``partition_by``
    if given: small pieces are merged and a value with very many rows is split
    over several tasks, so files have about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` whatever the skew;
    ``max_rows_per_file`` bounds them by rows as well.  ``changed_only``
    replaces only the partitions (years, say) that ``df`` has rows of.
    """
    if changed_only and not (partition_by and mode == "overwrite"):
        raise ValueError("changed_only needs partition_by and mode='overwrite'")
    if balanced:
        df = df.hint("rebalance", *(partition_by or []))
    w = df.write.mode(mode)
    if max_rows_per_file:
        w = w.option("maxRecordsPerFile", max_rows_per_file)
    if changed_only:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite", sep: str = ",") -> None:
    """Comma separated, with header, no index column."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", **kwargs) -> None:
    if fmt == "parquet":
        write_parquet(df, path, **kwargs)
    elif fmt == "csv":
        write_csv(df, path, **kwargs)
    else:
        raise ValueError(f"format must be one of {FORMATS}")


def table_name(name: str) -> str:
    """Catalog-safe table name: ``-`` and other non-word characters → ``_``."""
    return re.sub(r"\W", "_", name)


class ExportFailed(RuntimeError):
    """Some tables could not be exported; ``status`` has every table's outcome."""

    def __init__(self, status: dict[str, str]):
        self.status = status
        super().__init__("; ".join(f"{n}: {s}" for n, s in status.items() if s.startswith("failed")))


def failure(exc: Exception) -> str:
    said = str(exc).strip()
    return f"failed: {type(exc).__name__}: {said.splitlines()[0][:300] if said else ''}"


def _export(df: DataFrame, path: str, fmt: str) -> str:
    rows = Observation()
    try:
        write_table(df.observe(rows, F.count(F.lit(1)).alias("rows")), path, fmt)
    except Exception:
        remove_path(df.sparkSession, path)
        raise
    if rows.get.get("rows", 0):
        return "written"
    remove_path(df.sparkSession, path)
    return "empty, skipped"


def export_tables(tables: Mapping[str, DataFrame], target_dir: str, fmt: str = "parquet", *,
                  at_once: int = 4, cancel_on_failure: bool = False) -> dict[str, str]:
    """Write every table, skip empty ones; returns a status per table.

    Each table is computed once: the write counts its rows.  An empty table's
    target is removed.  A table that fails leaves no target either; the others
    are still written, then ``ExportFailed`` names what failed and why.  With
    ``cancel_on_failure`` a failure cancels the tables not yet written.

    ``at_once`` tables are submitted at a time, each in a scheduler pool of
    its own (equal shares under ``spark.scheduler.mode=FAIR``), so the last
    tasks of one table don't leave the cluster idle.
    """
    if not tables:
        return {}
    sc = next(iter(tables.values())).sparkSession.sparkContext
    tag = f"fixreg-export-{uuid.uuid4().hex[:12]}"
    stop: list[str] = []
    status = dict.fromkeys(tables, CANCELLED)

    def one(name: str, df: DataFrame) -> str:
        if stop:
            return CANCELLED
        sc.setLocalProperty("spark.scheduler.pool", f"{tag}-{name}")
        sc.addJobTag(tag)
        try:
            return _export(df, f"{target_dir.rstrip('/')}/{table_name(name)}", fmt)
        except Exception as exc:  # raised below, after the other tables
            if stop:
                return CANCELLED
            log.warning("export of %s failed: %s", name, exc)
            return failure(exc)
        finally:
            sc.removeJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max(1, min(at_once, len(tables)))) as pool:
        jobs = {pool.submit(inheritable_thread_target(next(iter(tables.values())).sparkSession)(one), n, df): n for n, df in tables.items()}
        for job in as_completed(jobs):
            status[jobs[job]] = job.result()
            if cancel_on_failure and status[jobs[job]].startswith("failed") and not stop:
                stop.append(jobs[job])
                sc.cancelJobsWithTag(tag)
    if any(s.startswith("failed") for s in status.values()):
        raise ExportFailed(status)
    return status


def export_folder(spark: SparkSession, source_dir: str, target_dir: str, fmt: str = "csv") -> dict[str, str]:
    """W3, folder to folder: every Parquet table below ``source_dir`` in another format."""
    names = table_folders(spark, source_dir)
    return export_tables({n: spark.read.parquet(f"{source_dir.rstrip('/')}/{n}") for n in names}, target_dir, fmt)


def table_folders(spark: SparkSession, directory: str) -> list[str]:
    """Names of the tables (folders) below a directory, sorted; hidden ones are left out."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory())
    return [n for n in names if not n.startswith(("_", "."))]


_VERSIONED = re.compile(r"(.+)__v[0-9a-f]{12}$")


def publish_tables(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, *,
                   location: str | None = None, replace_database: bool = False, keep: Sequence[str] = ()) -> list[str]:
    """One catalog name per DataFrame (names normalised).

    A name is a view over a versioned table ``name__v…``.  All new versions
    are written first; only when every one is complete are the views swapped,
    and only then do the versions they replace go.  If a table fails, its
    siblings' new versions are removed and the names show what they showed
    before.  With ``location`` the tables are external, stored below that
    folder.  ``replace_database`` also drops the names that are not published
    any more (but those in ``keep``), as the register tool replaces its
    database file, again after the new ones stand.
    """
    version = uuid.uuid4().hex[:12]
    where = f" LOCATION '{location.rstrip('/')}/{database}.db'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    new: dict[str, str] = {}
    try:
        for name, df in tables.items():
            t = table_name(name)
            full = f"{database}.{t}__v{version}"
            w = df.write.format("parquet")
            if location:
                w = w.option("path", f"{location.rstrip('/')}/{t}__v{version}")
            new[t] = full
            w.saveAsTable(full)
    except Exception:
        for t, full in new.items():
            _drop_version(spark, full, location)
        raise
    before = {x.name.lower(): x.tableType for x in spark.catalog.listTables(database) if not x.name.endswith(version)}
    for t, full in new.items():
        if before.get(t.lower(), "VIEW") != "VIEW":  # a table from before there were versions
            spark.sql(f"DROP TABLE {database}.`{t}`")
        spark.sql(f"CREATE OR REPLACE VIEW {database}.`{t}` AS SELECT * FROM {full}")
    published, kept = {t.lower() for t in new}, {table_name(k).lower() for k in keep}
    for t, kind in before.items():
        old = _VERSIONED.match(t)
        if old and (old[1] in published or replace_database):
            _drop_version(spark, f"{database}.{t}", location)
        elif replace_database and not old and t not in published and t not in kept:
            spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} {database}.`{t}`")
    return [f"{database}.{t}" for t in new]


def _drop_version(spark: SparkSession, full: str, location: str | None) -> None:
    path = None
    if location and spark.catalog.tableExists(full):  # names in the catalog may be lower-cased, those of folders are not
        path = next((r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect() if r["col_name"] == "Location"), None)
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    if location:
        remove_path(spark, path or f"{location.rstrip('/')}/{full.split('.', 1)[1]}")


def publish_view(spark: SparkSession, database: str, view: str, table: str | list[str]) -> str:
    """Stable view name over a year-specific table, or over several (all
    their rows by column name; a column that a table lacks is null in its rows)."""
    full = f"{database}.{table_name(view)}"
    tables = [table] if isinstance(table, str) else list(table)
    own = {t: spark.table(f"{database}.{table_name(t)}").columns for t in tables}
    columns = list(dict.fromkeys(c for cols in own.values() for c in cols))
    parts = [f"SELECT {', '.join(f'`{c}`' if c in own[t] else f'NULL AS `{c}`' for c in columns)} FROM {database}.{table_name(t)}" for t in tables]
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS {' UNION ALL '.join(parts)}")
    return full
