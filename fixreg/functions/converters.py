"""Column converters (C1–C9): cut text cell → typed value, as Column expressions.

A converter has two steps.  ``parse`` turns the trimmed cell (null when blank)
into a value and yields null when the text is not valid; ``finish`` applies
value rules such as "zero means missing".  A *bad value* is a non-null cell
whose parse is null; it is counted, or raises in strict mode (ledger L4).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Converter:
    name: str
    dtype: T.DataType
    parse: Callable[[Column], Column]
    finish: Callable[[Column], Column] = lambda v: v
    can_fail: bool = True

    def apply(self, cell: Column) -> Column:
        return self.finish(self.parse(cell)).cast(self.dtype)


_REGISTRY: dict[str, Converter] = {}

# Converter names used by existing layout files, mapped to ours.
ALIASES = {
    "convert_to_object": "string",
    "convert_to_int64": "bigint",
    "convert_to_float64": "double",
    "convert_to_date": "date",
    "convert_to_none": "null",
    "convert_geslacht": "sex",
    "convert_opleidingsvorm": "study_mode",
    "convert_to_int_zero_to_nan": "bigint_zero_null",
}

# Labels the register uses for sex and study mode codes.
SEX_LABELS = {"M": "man", "V": "vrouw"}
SEX_OTHER = "onbekend"
STUDY_MODE_LABELS = {1: "voltijd", 2: "deeltijd", 3: "duaal"}

DATE_FORMAT = "yyyyMMdd"


def register_converter(
    name: str,
    dtype: T.DataType,
    parse: Callable[[Column], Column],
    finish: Callable[[Column], Column] | None = None,
    can_fail: bool = True,
) -> Converter:
    """Register a named converter usable from a layout file.

    ``parse`` receives the trimmed cell as a Column.  A vectorised
    ``pandas_udf`` can be passed as ``parse`` when no built-in function fits.
    """
    conv = Converter(name, dtype, parse, finish or (lambda v: v), can_fail)
    _REGISTRY[name] = conv
    return conv


def column_converter(dtype: T.DataType, name: str | None = None, can_fail: bool = True):
    """Decorator form of :func:`register_converter`."""

    def wrap(fn: Callable[[Column], Column]):
        register_converter(name or fn.__name__, dtype, fn, can_fail=can_fail)
        return fn

    return wrap


def get_converter(name: str | None) -> tuple[Converter, bool]:
    """Look up a converter; unknown names fall back to string (S3, J4: the
    layout × converter-registry lookup).

    Returns ``(converter, known)``.
    """
    key = ALIASES.get(name or "", name or "")
    if key in _REGISTRY:
        return _REGISTRY[key], True
    return _REGISTRY["string"], False


def registered() -> list[str]:
    return sorted(_REGISTRY)


def _study_mode(v: Column) -> Column:
    code = v.try_cast("int")
    out = F.when(code.isNull(), v)
    for k, lab in STUDY_MODE_LABELS.items():
        out = out.when(code == k, F.lit(lab))
    return out.otherwise(v)


def _sex(v: Column) -> Column:
    out = None
    for k, lab in SEX_LABELS.items():
        out = (F.when if out is None else out.when)(v == k, F.lit(lab))
    return out.otherwise(F.lit(SEX_OTHER))


register_converter("string", T.StringType(), lambda c: c, can_fail=False)  # C1
register_converter("bigint", T.LongType(), lambda c: c.try_cast("bigint"))  # C2
register_converter("double", T.DoubleType(), lambda c: c.try_cast("double"))  # C3
# yyyyMMdd; blank, "00000000" and impossible dates → null (ledger L25)
register_converter("date", T.DateType(), lambda c: F.try_to_date(c, DATE_FORMAT))
register_converter("null", T.StringType(), lambda c: F.lit(None).cast("string"), can_fail=False)  # C5
register_converter("sex", T.StringType(), lambda c: c, finish=_sex, can_fail=False)  # C6
register_converter("study_mode", T.StringType(), lambda c: c, finish=_study_mode, can_fail=False)  # C7
register_converter(  # C8
    "bigint_zero_null", T.LongType(), lambda c: c.try_cast("bigint"), finish=lambda v: F.nullif(v, F.lit(0))
)
