"""The two workflows of the register tool as Spark jobs.

* ``convert_register``: folder of fixed-width extracts → typed tables (S6),
  local ids attached (P5), person ids pseudonymised and direct identifiers
  blanked (P4), written as Parquet or CSV (W3), one table per layout with the
  source file as a lineage column.  Unreadable cells are counted by column,
  records with undeclared data can be set apart in a second table (S4).
* ``create_assets``: converted tables → ``enrolment_enriched`` (E0),
  ``cohort`` (K1–K15) and ``exam_grade`` (X0), and the programmes that have
  no local name (E11).  The enriched table is written first and read back, so
  the cohort starts from stored data instead of recomputing the enrichment
  (the register tool recomputes it five times).
* ``publish_assets``: catalog tables plus stable-name views (W4, W5).
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from fixreg.functions.lattice import union_deliveries
from fixreg.operators.privacy import PERSON_ID, add_local_id, pseudonymise
from fixreg.plans.cohort import build_cohort
from fixreg.plans.enrich import Lookups, enrich_enrolments, observed_unmatched, programmes_without_local_name
from fixreg.plans.exams import build_exam_grades
from fixreg.session import ScratchSpace
from fixreg.sinks import ExportFailed, export_tables, failure, publish_tables, publish_view, table_folders, table_name, write_table
from fixreg.sources.delimited import read_delimited
from fixreg.sources.fixed_width import QUARANTINED, SOURCE_FILE, read_directory, read_editions, split_quarantine
from fixreg.sources.layout import Layout, LayoutEditions

log = logging.getLogger(__name__)

ENROLMENT_PREFIX, EXAM_PREFIX = "EV", "VAKHAV"
LOCAL_NAME_COLUMNS = ["Opleidingscode", "CodeOpleiding", "NaamOpleiding", "NaamFaculteit", "CodeFaculteit"]


@dataclass(frozen=True)
class TableAccount:
    """What a conversion read for one table: ``records`` that are not blank;
    of them with undeclared data (``garbage``) and set apart (``quarantined``);
    and ``bad_cells`` by column, made null because their converter could not read them."""

    records: int
    garbage: int
    quarantined: int
    bad_cells: Mapping[str, int] = field(default_factory=dict)

    def __str__(self) -> str:
        cells = ", ".join(f"{c} {n}" for c, n in self.bad_cells.items())
        parts = [f"unreadable cells: {cells}"] if cells else []
        parts += [f"quarantined records: {self.quarantined}"] if self.quarantined else []
        return "; ".join(parts)


class ConversionStatus(dict):
    """Outcome by table and by skipped input entry; ``accounts`` by converted table."""

    def __init__(self, status: Mapping[str, str], accounts: Mapping[str, TableAccount]):
        super().__init__(status)
        self.accounts = dict(accounts)


def _account(seen: Observation, quarantine: bool) -> TableAccount:
    got = seen.get
    bad = {k.removeprefix("bad_"): n for k, n in got.items() if k.startswith("bad_") and n}
    return TableAccount(got["rows"], got["garbage_rows"], got["garbage_rows"] if quarantine else 0, bad)


def convert_register(
    spark: SparkSession,
    source_dir: str,
    target_dir: str,
    *,
    fmt: str = "parquet",
    typed: bool = True,
    remove_pii: bool = True,
    salt: str | None = None,
    mode: str = "hash",
    layouts: dict[str, Layout] | LayoutEditions | None = None,
    on_garbage: str = "fail",
    garbage_width: int | None = None,
    quarantine_dir: str | None = None,
    strict: bool = False,
    na_values: tuple[str, ...] = (),
    offsets: str = "cumulative",
    local_ids: DataFrame | None = None,
    local_id_keys: tuple[str, str] = (PERSON_ID, PERSON_ID),
) -> ConversionStatus:
    """Convert every recognised extract in ``source_dir``; returns a status
    per table and per skipped input entry, with an account of each table.  A
    table that cannot be converted raises ``ExportFailed`` after the others
    are written.

    ``on_garbage="quarantine"`` writes records with undeclared data to a table
    of the same name below ``quarantine_dir``: good and quarantined rows are
    all records.  These are raw lines with whatever identifiers they hold, so
    the folder has to be named, and should be as restricted as the input.

    With ``LayoutEditions`` as ``layouts`` there is one table for each family
    of layouts, over all years of delivery, each file cut by its year's layout.

    ``local_ids`` attaches the institution's own ids to the enrolment and exam
    tables by ``local_id_keys`` (the tables' column, the ids' column, which is
    not written), whether or not ids are pseudonymised (L13).

    A table that is read more than once (``permute``), joined before it is
    written, or has two outputs is parsed once into scratch storage, which is
    removed at the end, failure or not.  In ``permute`` mode one crosswalk
    serves all persons, so if one of their tables fails, none is written.
    """
    quarantine = on_garbage == "quarantine"
    if quarantine and not quarantine_dir:
        raise ValueError("on_garbage='quarantine' needs a quarantine_dir for the records set apart")
    if remove_pii and mode not in ("hash", "permute"):
        raise ValueError("mode must be hash or permute")
    read = read_editions if isinstance(layouts, LayoutEditions) else read_directory
    scan = read(spark, source_dir, layouts, observe=True, typed=typed, on_garbage="tag" if quarantine else on_garbage,
                          garbage_width=garbage_width, strict=strict, na_values=tuple(na_values), offsets=offsets)
    tables, apart, failed = dict(scan.tables), {}, {}
    people = [n for n, t in tables.items() if n.startswith((ENROLMENT_PREFIX, EXAM_PREFIX)) and PERSON_ID in t.columns]
    if remove_pii and people and not salt:
        raise ValueError("remove_pii needs a secret salt")
    with ScratchSpace(spark, "convert") as scratch:
        for n in list(tables):
            if quarantine or n in people and (local_ids is not None or remove_pii and mode == "permute"):
                try:
                    tables[n] = scratch.write(tables[n], table_name(n), [QUARANTINED] if quarantine else None)
                except Exception as exc:  # raised below, after the other tables
                    failed[n] = failure(exc)
                    del tables[n]
                    continue
            if quarantine:
                tables[n], apart[n] = split_quarantine(tables[n])
        if remove_pii and mode == "permute" and any(n in failed for n in people):
            for n in [n for n in people if n in tables]:
                failed[n] = "failed: not written, as another table of the crosswalk failed"
                del tables[n], scan.observations[n]
                apart.pop(n, None)
        there = [n for n in people if n in tables]
        if local_ids is not None:
            left, right = local_id_keys
            for n in there:
                joined = add_local_id(tables[n], local_ids, left, right)
                tables[n] = joined.drop(right) if right != left else joined
        if remove_pii and there:
            tables.update(pseudonymise({n: tables[n] for n in there}, salt=salt, mode=mode, scratch=scratch))
        try:
            status = export_tables(tables, target_dir, fmt)
        except ExportFailed as exc:
            status = exc.status
        status.update(failed)
        done = [n for n in tables if not status[n].startswith("failed")]
        accounts = {n: _account(scan.observations[n], quarantine) for n in done}
        set_apart = {n: df for n, df in apart.items() if n in accounts and accounts[n].quarantined}
        if set_apart:
            try:
                export_tables(set_apart, quarantine_dir, fmt)
            except ExportFailed as exc:
                status.update({f"{n} (quarantine)": s for n, s in exc.status.items() if s.startswith("failed")})
    for n, account in accounts.items():
        if str(account):
            status[n] = f"{status[n]}; {account}"
    status.update({e: s for e, s in scan.status.items() if not s.startswith("read")})
    if any(s.startswith("failed") for s in status.values()):
        raise ExportFailed(ConversionStatus(status, accounts))
    return ConversionStatus(status, accounts)


def _converted(spark: SparkSession, converted_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{converted_dir.rstrip('/')}/{table_name(name)}")


def _code_list(spark: SparkSession, converted_dir: str, name: str) -> DataFrame:
    # A code list's file lineage is not carried into the tables it enriches.
    return _converted(spark, converted_dir, name).drop(SOURCE_FILE)


def converted_tables(spark: SparkSession, converted_dir: str, prefix: str) -> DataFrame | None:
    """All rows of the converted tables whose name begins with ``prefix`` (one
    per year of delivery), by column name; None if there is none.  A column
    whose type changed between deliveries has their common type; the changes
    are logged."""
    found = {name: _converted(spark, converted_dir, name) for name in table_folders(spark, converted_dir) if name.startswith(prefix)}
    if not found:
        return None
    out, conflicts = union_deliveries(found)
    for c in conflicts:
        log.warning("%s: column %s is %s over %s", prefix, c.column, c.chosen, dict(c.types))
    return out


def create_assets(
    spark: SparkSession,
    converted_dir: str,
    assets_dir: str,
    *,
    local_names_path: str | None = None,
    observed_until: int | None = None,
) -> dict[str, str]:
    """Build and write the analysis tables as Parquet; returns their paths.

    With ``local_names_path`` the programmes without a local name (E11) are
    written too, as ``programmes_without_local_name``.  The write of the
    enriched table finds their codes in passing, in a bounded aggregate; only
    if there are any are two columns of the stored table read for their names."""
    out = assets_dir.rstrip("/")
    written: dict[str, str] = {}
    enrolments = converted_tables(spark, converted_dir, ENROLMENT_PREFIX)
    if enrolments is not None:
        local = (read_delimited(spark, local_names_path, LOCAL_NAME_COLUMNS) if local_names_path else None)
        lookups = Lookups(
            _code_list(spark, converted_dir, "Dec_vopl"),
            _code_list(spark, converted_dir, "Dec_brinvestigingsnummer"),
            _code_list(spark, converted_dir, "Dec_isat"),
            _code_list(spark, converted_dir, "Dec_ho_ISCED"),
            local,
        )
        unmatched = Observation() if local is not None else None
        enriched = enrich_enrolments(enrolments, lookups, unmatched=unmatched)
        write_table(enriched, f"{out}/enrolment_enriched")
        written["enrolment_enriched"] = f"{out}/enrolment_enriched"
        stored = spark.read.parquet(f"{out}/enrolment_enriched")
        if local is not None:
            report = programmes_without_local_name(stored, local, codes=observed_unmatched(unmatched))
            write_table(report, f"{out}/programmes_without_local_name")
            written["programmes_without_local_name"] = f"{out}/programmes_without_local_name"
        with ScratchSpace(spark, "cohort") as scratch:
            write_table(build_cohort(stored, observed_until=observed_until, stored=True, scratch=scratch), f"{out}/cohort")
        written["cohort"] = f"{out}/cohort"
    exams = converted_tables(spark, converted_dir, EXAM_PREFIX)
    if exams is not None:
        grades = build_exam_grades(exams, _code_list(spark, converted_dir, "Dec_vooropl"))
        write_table(grades, f"{out}/exam_grade")
        written["exam_grade"] = f"{out}/exam_grade"
    return written


def publish_assets(spark: SparkSession, converted_dir: str, database: str, *, location: str | None = None,
                   replace_database: bool = False) -> list[str]:
    """Publish the converted tables to the catalog, with stable views
    ``enrolment`` and ``exam_subject`` over the year-specific tables."""
    names = table_folders(spark, converted_dir)
    tables = {n: _converted(spark, converted_dir, n) for n in names}
    views = {"enrolment": ENROLMENT_PREFIX, "exam_subject": EXAM_PREFIX}
    done = publish_tables(spark, tables, database, location=location, replace_database=replace_database, keep=list(views))
    for view, prefix in views.items():
        source = [n for n in names if n.startswith(prefix)]
        if source:
            done.append(publish_view(spark, database, view, source))
    return done
