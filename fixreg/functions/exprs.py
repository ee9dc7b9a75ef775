"""Generic column expressions (JVM-side, codegen-friendly; no Python UDFs).

The reference works in pandas, where a comparison with a missing value is
False.  Spark SQL is three-valued, so every predicate that becomes a flag or a
filter goes through ``truthy`` first (ledger L8).
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters pandas' fixed-width reader strips around a cell.
BLANKS = " \t\r\n"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cell(c: str | Column) -> Column:
    """Trim blanks; an empty cell is null."""
    return F.nullif(F.btrim(col_(c), F.lit(BLANKS)), F.lit(""))


def truthy(pred: Column) -> Column:
    """Two-valued logic: a null predicate counts as False."""
    return F.coalesce(pred, F.lit(False))


def flag(pred: Column) -> Column:
    """0/1 integer flag from a predicate, null → 0."""
    return F.when(truthy(pred), F.lit(1)).otherwise(F.lit(0))


def label(pred: Column, yes: str, no: str) -> Column:
    """Two-label flag from a predicate, null → ``no``."""
    return F.when(truthy(pred), F.lit(yes)).otherwise(F.lit(no))


def eq(a: str | Column, b: str | Column) -> Column:
    """pandas-style equality: missing never equals anything."""
    return truthy(col_(a) == col_(b))


def as_int(c: str | Column) -> Column:
    """Integer view of a code column that may be stored as text (L1)."""
    return col_(c).try_cast("bigint")


def recode(
    c: str | Column,
    mapping: Mapping[Any, Any],
    *,
    keep_unmapped: bool = True,
    default: Any = None,
) -> Column:
    """Recode by a literal map (G1).

    Unmapped values are kept (``keep_unmapped``) or nulled; a null result is
    replaced by ``default`` when given.
    """
    src = col_(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    parts = [F.try_element_at(m, src)]
    if keep_unmapped:
        parts.append(src)
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def zero_pad(c: str | Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole.

    Spark's ``lpad`` truncates longer input, Python's ``zfill`` does not (G11).
    """
    s = col_(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def whole_word(c: str | Column, word: str) -> Column:
    """Regex whole-word search (``\\b`` on both sides), literal word."""
    import re

    return col_(c).rlike(r"\b" + re.escape(word) + r"\b")


def fail_if(cond: Column, message: str) -> Column:
    """Boolean column that raises ``message`` on rows where ``cond`` holds.

    Used in ``filter`` so checks run inside the same pass as the data instead
    of a separate counting job; the optimizer cannot prune a filter.
    """
    return F.when(truthy(cond), F.raise_error(F.lit(message))).otherwise(F.lit(True))
