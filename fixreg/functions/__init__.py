"""Column-level functions: converters, recodes, flags, text rules."""

from fixreg.functions.codes import (
    classify_prior_education,
    diploma_kind_of,
    profile_of,
    programme_type_of,
    sector_of,
)
from fixreg.functions.converters import (
    Converter,
    column_converter,
    get_converter,
    register_converter,
    registered,
)
from fixreg.functions.exprs import as_int, cell, eq, fail_if, flag, label, recode, truthy, zero_pad

__all__ = [
    "Converter",
    "as_int",
    "cell",
    "classify_prior_education",
    "column_converter",
    "diploma_kind_of",
    "eq",
    "fail_if",
    "flag",
    "get_converter",
    "label",
    "profile_of",
    "programme_type_of",
    "recode",
    "register_converter",
    "registered",
    "sector_of",
    "truthy",
    "zero_pad",
]
