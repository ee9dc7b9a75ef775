"""Fixed-width scan (S1–S7) as DataFrame expressions.

``spark.read.text`` splits files into lines in parallel (splittable, no
Python); each line is decoded from latin1 and cut with ``substring`` into
columns; converters are Column expressions, so the whole scan runs inside
whole-stage codegen.  Nothing is collected: per-cell failures and undeclared
trailing data are counted through an ``Observation`` or raised lazily.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.functions.converters import get_converter
from fixreg.functions.exprs import BLANKS, cell, fail_if
from fixreg.functions.lattice import common_type
from fixreg.sources.layout import GARBAGE_COLUMN, Edition, Layout, LayoutEditions, layouts_in, resolve_layout
from fixreg.sources.tables import spread

LINE = "__line"
SOURCE_FILE = "source_file"
RECORD = "record"
QUARANTINED = "quarantined"
ENCODING = "ISO-8859-1"
_SCHEME = "^[A-Za-z0-9+.-]+:/+"  # file:/x and file:///x are one path


def decode_lines(raw: DataFrame, encoding: str = ENCODING, keep_source: bool = False) -> DataFrame:
    """Text-source rows → decoded ``__line`` (plus the source file name)."""
    cols = [F.decode(F.col("value").cast("binary"), encoding).alias(LINE)]
    if keep_source:
        cols.append(F.col("_metadata.file_path").alias(SOURCE_FILE))
    return raw.select(*cols)


def _cut(line: Column, start: int, width: int) -> Column:
    return F.substring(line, start, width)


def garbage_of(line: Column, layout: Layout, offsets: str = "cumulative",
               width: int | None = None) -> Column:
    """Non-blank text after the record (S4): anywhere in the rest of the line,
    or in the ``width`` positions after it (the register tool's probe has
    ``GARBAGE_WIDTH``)."""
    return cell(_cut(line, layout.garbage_start(offsets), width if width is not None else 2**31 - 1))


def parse_fixed_width(
    lines: DataFrame,
    layout: Layout,
    *,
    line_col: str = LINE,
    typed: bool = True,
    offsets: str = "cumulative",
    on_garbage: str = "fail",
    strict: bool = False,
    keep: tuple[str, ...] = (),
    observation: Observation | None = None,
    na_values: tuple[str, ...] = (),
    garbage_width: int | None = None,
) -> DataFrame:
    """Cut a column of text lines into the layout's columns.

    * blank lines are skipped; short lines give null trailing columns;
    * ``typed=False`` keeps every column as trimmed text (S2);
    * ``on_garbage``: ``fail`` raises when a record has undeclared trailing
      data, ``keep`` adds it as ``GarbageColumn`` (reference behaviour, L3),
      ``quarantine`` drops such rows (get them with :func:`garbage_rows`),
      ``tag`` keeps all rows and marks them for :func:`split_quarantine`: both
      outputs come from one pass;
    * ``strict=True`` raises on a cell the converter cannot read; otherwise
      the value becomes null and is counted in ``observation`` (L4), for the
      records that are not set apart;
    * ``keep`` carries extra input columns (e.g. the source file) through;
    * ``na_values``: extra cell texts read as missing (pandas-compatible
      sentinels such as ``NA``); by default only a blank cell is missing (L5);
    * ``garbage_width``: how far after the record to look for undeclared data;
      by default to the end of the line, 10 positions as the register tool does.
    """
    line = F.col(line_col)
    cells = _cells(line, layout, typed, offsets, strict, na_values)
    message = f"layout {layout.name}: data found after position {layout.garbage_start(offsets) - 1}"
    return _rows(lines, line, cells, garbage_of(line, layout, offsets, garbage_width), message, on_garbage, keep, observation)


def _cells(line: Column, layout: Layout, typed: bool, offsets: str, strict: bool, na_values: tuple[str, ...]) -> dict[str, tuple[Column, Column | None]]:
    """By column of the layout: its value, and whether the cell could not be read (None where any cell can)."""
    out: dict[str, tuple[Column, Column | None]] = {}
    for spec, start in zip(layout.columns, layout.starts(offsets)):
        raw = cell(_cut(line, start, spec.width))
        if na_values:
            raw = F.when(~raw.isin(*na_values), raw)
        if not typed:
            out[spec.name] = raw, None
            continue
        conv, _known = get_converter(spec.converter)
        parsed = conv.parse(raw)
        value = conv.finish(parsed).cast(conv.dtype)
        bad = raw.isNotNull() & parsed.isNull() if conv.can_fail else None
        if bad is not None and strict:
            msg = f"layout {layout.name}: column {spec.name} has a value that is not {spec.converter}"
            value = F.when(bad, F.raise_error(F.lit(msg)).cast(conv.dtype)).otherwise(value)
        out[spec.name] = value, None if strict else bad
    return out


def _rows(lines: DataFrame, line: Column, cells: dict[str, tuple[Column, Column | None]], garbage: Column, message: str | Column,
          on_garbage: str, keep: tuple[str, ...], observation: Observation | None) -> DataFrame:
    """The lines that are not blank as rows of ``cells``, under the garbage policy."""
    if on_garbage not in ("fail", "keep", "quarantine", "tag"):
        raise ValueError("on_garbage must be fail, keep, quarantine or tag")
    nonblank = lines.filter(F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    out_cols = [F.col(k) for k in keep] + [value.alias(name) for name, (value, _) in cells.items()]
    if observation is not None:
        # Measured before the garbage policy filters or raises.
        kept = garbage.isNull() if on_garbage in ("quarantine", "tag") else F.lit(True)
        metrics = [F.count(F.lit(1)).alias("rows"), F.count(garbage).alias("garbage_rows")]
        metrics += [F.count_if(bad & kept).alias(f"bad_{name}") for name, (_, bad) in cells.items() if bad is not None]
        nonblank = nonblank.observe(observation, *metrics)
    if on_garbage == "fail":
        nonblank = nonblank.filter(fail_if(garbage.isNotNull(), message))
    elif on_garbage == "quarantine":
        nonblank = nonblank.filter(garbage.isNull())
    elif on_garbage == "tag":
        bad = garbage.isNotNull()
        out_cols += [garbage.alias(GARBAGE_COLUMN), F.when(bad, line).alias(RECORD), bad.alias(QUARANTINED)]
    else:
        out_cols.append(garbage.alias(GARBAGE_COLUMN))
    return nonblank.select(*out_cols)


def parse_editions(lines: DataFrame, editions: list[Edition], year: Column, *, line_col: str = LINE, typed: bool = True, offsets: str = "cumulative",
                   on_garbage: str = "fail", strict: bool = False, keep: tuple[str, ...] = (), observation: Observation | None = None,
                   na_values: tuple[str, ...] = (), garbage_width: int | None = None) -> DataFrame:
    """Cut each line by the layout that was valid in its ``year`` (S3, S5), all in one pass.

    The columns are those of all editions, by name; one that an edition lacks
    is null in its lines, and a column whose type changed has the common type
    (``common_type``).  A line of no year takes the newest edition, one of a
    year before the oldest raises.  The options are those of
    :func:`parse_fixed_width`.
    """
    line, newest_first = F.col(line_col), sorted(editions, key=lambda e: -e.since)
    each = [(e, _cells(line, e.layout, typed, offsets, strict, na_values)) for e in newest_first]
    valid = [year.isNull() | (year >= F.lit(newest_first[0].since)), *[year >= F.lit(e.since) for e in newest_first[1:]]]

    def chosen(values: list[Column | None], otherwise: Column) -> Column:
        out = None
        for ok, value in zip(valid, values):
            value = otherwise if value is None else value
            out = F.when(ok, value) if out is None else out.when(ok, value)
        return out.otherwise(otherwise)

    types: dict[str, T.DataType] = {}
    for e, _ in reversed(each):
        for f in e.layout.schema(typed).fields:
            types[f.name] = common_type(types[f.name], f.dataType) if f.name in types else f.dataType
    cells = {}
    for name, kind in types.items():
        values = [c[name][0].cast(kind) if name in c else None for _, c in each]
        bad = [c[name][1] if name in c else None for _, c in each]
        cells[name] = chosen(values, F.lit(None).cast(kind)), chosen(bad, F.lit(False)) if any(b is not None for b in bad) else None
    oldest = newest_first[-1]
    lines = lines.filter(fail_if(year < F.lit(oldest.since), f"no layout of {oldest.layout.name} is valid before {oldest.since}"))
    garbage = chosen([garbage_of(line, e.layout, offsets, garbage_width) for e, _ in each], F.lit(None).cast("string"))
    return _rows(lines, line, cells, garbage, f"layouts {', '.join(e.layout.name for e, _ in reversed(each))}: data found after the record",
                 on_garbage, keep, observation)


def split_quarantine(tagged: DataFrame, keep: tuple[str, ...] = (SOURCE_FILE,)) -> tuple[DataFrame, DataFrame]:
    """The two outputs of ``on_garbage="tag"``: the good rows with the layout's
    columns, and the records set apart as they came, with what was found
    behind them.  The rows of both are all rows of the input."""
    good = tagged.filter(~F.col(QUARANTINED)).drop(GARBAGE_COLUMN, RECORD, QUARANTINED)
    bad = tagged.filter(QUARANTINED).select(*[k for k in keep if k in tagged.columns], RECORD, GARBAGE_COLUMN)
    return good, bad


def garbage_rows(lines: DataFrame, layout: Layout, *, line_col: str = LINE, offsets: str = "cumulative",
                 keep: tuple[str, ...] = (), garbage_width: int | None = None) -> DataFrame:
    """Records with undeclared trailing data, with their raw line (quarantine side)."""
    line = F.col(line_col)
    g = garbage_of(line, layout, offsets, garbage_width)
    return lines.filter(g.isNotNull()).select(*[F.col(k) for k in keep], line.alias("record"),
                                              g.alias(GARBAGE_COLUMN))


def read_fixed_width(spark: SparkSession, paths: str | list[str], layout: Layout, *,
                     encoding: str = ENCODING, with_source: bool = False, spread_lines: bool = False, **kwargs) -> DataFrame:
    """Read fixed-width text files (S1/S2): latin1 lines → typed columns.

    Plain text is split by Spark into parallel tasks.  A file of a codec that
    cannot be split (e.g. gzip) arrives as one partition; ``spread_lines``
    deals its lines over the cluster before parsing.
    """
    raw = spark.read.text(paths)
    lines = decode_lines(raw, encoding, keep_source=with_source)
    if spread_lines:
        lines = spread(lines)
    keep = (SOURCE_FILE,) if with_source else ()
    return parse_fixed_width(lines, layout, keep=keep + tuple(kwargs.pop("keep", ())), **kwargs)


@dataclass
class InputEntry:
    """One top-level entry of an input folder: a file or a folder of parts."""

    name: str
    path: str
    bytes: int
    layout: str | None

    @property
    def stem(self) -> str:
        return self.name.rsplit(".", 1)[0] if "." in self.name else self.name


@dataclass
class DirectoryScan:
    tables: dict[str, DataFrame]
    entries: list[InputEntry]
    status: dict[str, str] = field(default_factory=dict)
    observations: dict[str, Observation] = field(default_factory=dict)  # by table, with ``observe``


def list_inputs(spark: SparkSession, source_dir: str, layout_names: list[str]) -> list[InputEntry]:
    """List the entries of ``source_dir`` with size and resolved layout.

    Uses the cluster's Hadoop file system (HDFS, object stores, local), so
    only file metadata is read; empty files are seen too.  Hidden entries
    (``_…``, ``.…``) are skipped, as Spark's readers do.  Each entry is
    listed once and resolves to at most one layout (ledger L26).
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(source_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    entries = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        size = fs.getContentSummary(st.getPath()).getLength() if st.isDirectory() else st.getLen()
        entries.append(InputEntry(name, st.getPath().toString(), int(size), None))
    entries.sort(key=lambda e: e.name)
    for e in entries:
        e.layout = resolve_layout(e.stem, layout_names)
    return entries


def read_directory(spark: SparkSession, source_dir: str, layouts: dict[str, Layout] | None = None, *,
                   observe: bool = False, **kwargs) -> DirectoryScan:
    """Read every recognised entry of a folder, one DataFrame per layout.

    Entries resolving to the same layout are read by one scan; empty entries
    are skipped; entries without a layout are reported, not read.  With
    ``observe`` the first job over a table counts its records, those with
    garbage and the unreadable cells of each column (``observations``).
    """
    layouts = layouts or layouts_in()
    entries = list_inputs(spark, source_dir, list(layouts))
    status: dict[str, str] = {}
    groups: dict[str, list[str]] = {}
    for e in entries:
        if e.layout is None:
            status[e.name] = "no layout"
        elif e.bytes == 0:
            status[e.name] = "empty"
        else:
            status[e.name] = f"read as {e.layout}"
            groups.setdefault(e.layout, []).append(e.path)
    seen = {name: Observation() for name in groups} if observe else {}
    tables = {
        name: read_fixed_width(spark, files, layouts[name], with_source=True, observation=seen.get(name), **kwargs)
        for name, files in groups.items()
    }
    return DirectoryScan(tables, entries, status, seen)


def read_editions(spark: SparkSession, source_dir: str, editions: LayoutEditions | None = None, *, encoding: str = ENCODING,
                  observe: bool = False, **kwargs) -> DirectoryScan:
    """Read every recognised entry of a folder, one DataFrame per family of
    layouts (S3, S5–S7): one scan over all its deliveries, each entry cut by
    the layout that was valid in the year its name ends in.

    An entry older than its family's first layout is reported, not read.
    """
    editions = editions or LayoutEditions.of(layouts_in())
    entries = list_inputs(spark, source_dir, [])
    status: dict[str, str] = {}
    groups: dict[str, list[str]] = {}
    for e in entries:
        family = editions.family_of(e.stem)
        layout = editions.valid(family, editions.year_of(e.stem)) if family else None
        e.layout = layout.name if layout else None
        if layout is None:
            status[e.name] = "no layout" if family is None else f"no layout of {family} was valid in {editions.year_of(e.stem)}"
        elif e.bytes == 0:
            status[e.name] = "empty"
        else:
            status[e.name] = f"read as {layout.name}"
            groups.setdefault(family, []).append(e.path)
    seen = {family: Observation() for family in groups} if observe else {}
    tables = {}
    for family, files in groups.items():
        lines = decode_lines(spark.read.text(files), encoding, keep_source=True)
        # The entry is the path's part below the folder; its name ends in the year.
        depth = re.sub(_SCHEME, "", files[0].rstrip("/")).count("/")
        entry = F.get(F.split(F.regexp_replace(SOURCE_FILE, _SCHEME, ""), "/"), depth)
        tables[family] = parse_editions(lines, editions[family], editions.year_column(F.regexp_replace(entry, r"\.[^.]*$", "")),
                                        keep=(SOURCE_FILE,), observation=seen.get(family), **kwargs)
    return DirectoryScan(tables, entries, status, seen)
