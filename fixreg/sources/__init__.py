"""Sources: layouts, fixed-width text (S1–S7), delimited lookups."""

from fixreg.sources.delimited import parse_delimited, read_delimited
from fixreg.sources.fixed_width import (
    decode_lines,
    garbage_rows,
    list_inputs,
    parse_editions,
    parse_fixed_width,
    read_directory,
    read_editions,
    read_fixed_width,
    split_quarantine,
)
from fixreg.sources.layout import ColumnSpec, Edition, Layout, LayoutEditions, get_layout, layouts_in, resolve_layout

__all__ = [
    "ColumnSpec",
    "Edition",
    "Layout",
    "LayoutEditions",
    "decode_lines",
    "garbage_rows",
    "get_layout",
    "layouts_in",
    "list_inputs",
    "parse_delimited",
    "parse_editions",
    "parse_fixed_width",
    "read_delimited",
    "read_directory",
    "read_editions",
    "read_fixed_width",
    "resolve_layout",
    "split_quarantine",
]
