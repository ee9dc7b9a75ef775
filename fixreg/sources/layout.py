"""Record layouts: column name, start, width and converter of a fixed-width file.

Layout files are CSV.  Two header styles are read:

* ours:        ``column,start,width,converter``
* the register's own: ``Label,StartingPosition,NumberOfPositions,Converter``

Both name the same four facts; converter names of either style resolve
through :mod:`fixreg.functions.converters`.
"""

from __future__ import annotations

import csv
import io
import logging
import re
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.functions.converters import get_converter

log = logging.getLogger(__name__)

LAYOUT_DIR = Path(__file__).parent / "layouts"

# Width of the register tool's probe for undeclared data after the record (S4),
# for callers that ask for it; by default the whole rest of the line is looked at.
GARBAGE_WIDTH = 10
GARBAGE_COLUMN = "GarbageColumn"

_HEADERS = {
    ("column", "start", "width", "converter"),
    ("Label", "StartingPosition", "NumberOfPositions", "Converter"),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    start: int  # declared 1-based start
    width: int
    converter: str = "string"


@dataclass(frozen=True)
class Layout:
    name: str
    columns: tuple[ColumnSpec, ...]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def record_width(self) -> int:
        """Width of a record when cut by cumulative widths."""
        return sum(c.width for c in self.columns)

    def starts(self, offsets: str = "cumulative") -> list[int]:
        """1-based start of every column.

        ``cumulative`` cuts each column right after the previous one, as the
        reader of the register does (ledger L6); ``declared`` uses the start
        written in the layout.
        """
        if offsets == "declared":
            return [c.start for c in self.columns]
        if offsets != "cumulative":
            raise ValueError(f"offsets must be 'cumulative' or 'declared', not {offsets!r}")
        out, pos = [], 1
        for c in self.columns:
            out.append(pos)
            pos += c.width
        return out

    def garbage_start(self, offsets: str = "cumulative") -> int:
        if offsets == "declared":
            return max(c.start + c.width for c in self.columns)
        return self.record_width + 1

    def issues(self) -> list[str]:
        """Declared starts that disagree with the cumulative cut, overlaps, gaps."""
        problems = []
        pos = 1
        for c in self.columns:
            if c.start != pos:
                problems.append(f"{self.name}.{c.name}: declared start {c.start}, cumulative {pos}")
            pos += c.width
        by_start = sorted(self.columns, key=lambda c: c.start)
        for a, b in zip(by_start, by_start[1:]):
            end = a.start + a.width
            if b.start < end:
                problems.append(f"{self.name}: {a.name} overlaps {b.name} ({a.start}+{a.width} > {b.start})")
            elif b.start > end:
                problems.append(f"{self.name}: gap of {b.start - end} before {b.name}")
        names = self.names
        for n in sorted({n for n in names if names.count(n) > 1}):
            problems.append(f"{self.name}: column {n} declared twice")
        return problems

    def unknown_converters(self) -> list[str]:
        return [c.name for c in self.columns if not get_converter(c.converter)[1]]

    def schema(self, typed: bool = True) -> T.StructType:
        fields = []
        for c in self.columns:
            dtype = get_converter(c.converter)[0].dtype if typed else T.StringType()
            fields.append(T.StructField(c.name, dtype, True))
        return T.StructType(fields)

    @staticmethod
    def parse_csv(name: str, text: str) -> "Layout":
        rows = list(csv.reader(io.StringIO(text)))
        rows = [r for r in rows if r and any(x.strip() for x in r)]
        if not rows:
            raise ValueError(f"layout {name} is empty")
        header = tuple(x.strip() for x in rows[0][:4])
        if header not in _HEADERS:
            raise ValueError(f"layout {name}: unknown header {rows[0]}")
        cols = []
        for r in rows[1:]:
            conv = r[3].strip() if len(r) > 3 and r[3].strip() else "string"
            cols.append(ColumnSpec(r[0].strip(), int(r[1]), int(r[2]), conv))
        layout = Layout(name, tuple(cols))
        unknown = layout.unknown_converters()
        if unknown:
            log.warning("layout %s: unknown converter for %s, read as string", name, unknown)
        return layout

    @classmethod
    def from_csv(cls, path: str | Path) -> "Layout":
        p = Path(path)
        return cls.parse_csv(p.stem, p.read_text(encoding="utf-8"))

    def to_csv(self) -> str:
        buf = io.StringIO()
        w = csv.writer(buf, lineterminator="\n")
        w.writerow(["column", "start", "width", "converter"])
        for c in self.columns:
            w.writerow([c.name, c.start, c.width, c.converter])
        return buf.getvalue()


def layouts_in(directory: str | Path | None = None) -> dict[str, Layout]:
    """All layouts of a folder (default: the bundled ones), by name, sorted."""
    d = Path(directory) if directory else LAYOUT_DIR
    return {p.stem: Layout.from_csv(p) for p in sorted(d.glob("*.csv"))}


def get_layout(name: str, directory: str | Path | None = None) -> Layout:
    found = layouts_in(directory)
    if name in found:
        return found[name]
    lowered = {k.lower(): v for k, v in found.items()}
    if name.lower() in lowered:
        return lowered[name.lower()]
    raise KeyError(f"no layout named {name}")


def resolve_layout(file_stem: str, layout_names: list[str]) -> str | None:
    """Layout for an input file.

    Same name ignoring case; else a stem containing ``EV`` takes the first
    ``EV…`` layout and one containing ``VAKHAV`` the first ``VAKHAV…`` layout.
    """
    names = sorted(layout_names)
    for n in names:
        if n.lower() == file_stem.lower():
            return n
    for marker in ("EV", "VAKHAV"):
        if marker in file_stem:
            for n in names:
                if n.startswith(marker):
                    return n
    return None


_YEAR = r"(20\d\d|\d\d)$"


def _dated(name: str) -> tuple[str, int | None]:
    """A name without the year it ends in, and that year (two digits: of this century)."""
    found = re.search(_YEAR, name)
    year = int(found[1]) % 100 + 2000 if found else None
    return (name[:found.start()] if found else name).rstrip("_"), year


@dataclass(frozen=True)
class Edition:
    """A layout and the first year it is valid in."""

    layout: Layout
    since: int


class LayoutEditions:
    """Layouts by family and year (S3, S5): an edition is valid from its year
    until the next one's, the newest without end."""

    def __init__(self, editions: Mapping[str, list[Edition]]):
        self._families = {f: sorted(es, key=lambda e: e.since) for f, es in editions.items()}
        for family, es in self._families.items():
            years = [e.since for e in es]
            if len(set(years)) < len(years):
                raise ValueError(f"two layouts of {family} are valid since the same year: {years}")

    @classmethod
    def of(cls, layouts: Mapping[str, Layout]) -> "LayoutEditions":
        """Families and years by the layouts' names: ``Dec_postcodecijfers_2023``
        and ``…_2024`` are two editions of one family; a name without a year is
        valid from the beginning."""
        families: dict[str, list[Edition]] = {}
        for name, layout in layouts.items():
            family, year = _dated(name)
            families.setdefault(family, []).append(Edition(layout, year or 0))
        return cls(families)

    def __getitem__(self, family: str) -> list[Edition]:
        return self._families[family]

    def families(self) -> list[str]:
        return sorted(self._families)

    def intervals(self, family: str) -> list[tuple[int, int | None, str]]:
        """(first year, last year or None, layout) of each edition."""
        es = self._families[family]
        return [(e.since, after.since - 1 if after else None, e.layout.name) for e, after in zip(es, [*es[1:], None])]

    def family_of(self, stem: str) -> str | None:
        """The family of an input file: its name without the year, ignoring
        case; else, as for single layouts, by ``EV`` or ``VAKHAV`` in it."""
        return resolve_layout(_dated(stem)[0], list(self._families))

    @staticmethod
    def year_of(stem: str) -> int | None:
        return _dated(stem)[1]

    def valid(self, family: str, year: int | None) -> Layout | None:
        """As-of rule: the newest layout whose first year is not after ``year``; of no year, the newest."""
        es = [e for e in self._families[family] if year is None or e.since <= year]
        return es[-1].layout if es else None

    @staticmethod
    def year_column(stem: Column) -> Column:
        """``year_of`` as an expression."""
        digits = F.regexp_extract(stem, _YEAR, 1)
        return F.when(digits != "", F.right(digits, F.lit(2)).cast("int") + 2000)
