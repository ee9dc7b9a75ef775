"""Converter edge vectors (FIXTURES A1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixreg.functions.converters import get_converter, register_converter
from fixreg.functions.exprs import cell


def convert(spark, name, values):
    conv, known = get_converter(name)
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(conv.apply(cell("v"))).collect()], known


def test_string_blank_is_null_and_na_kept(spark):
    out, _ = convert(spark, "convert_to_object", ["AB  ", "  ", "NA"])
    assert out == ["AB", None, "NA"]


def test_bigint_lenient(spark):
    out, _ = convert(spark, "convert_to_int64", ["0042", "    ", "x1"])
    assert out == [42, None, None]


def test_bigint_zero_to_null(spark):
    out, _ = convert(spark, "convert_to_int_zero_to_nan", ["000", "012", "   "])
    assert out == [None, 12, None]


def test_double(spark):
    out, _ = convert(spark, "convert_to_float64", ["1.50", ""])
    assert out == [1.5, None]


def test_date(spark):
    out, _ = convert(spark, "convert_to_date", ["20240101", "        ", "00000000", "20241301"])
    assert out == [dt.date(2024, 1, 1), None, None, None]


def test_null(spark):
    out, _ = convert(spark, "convert_to_none", ["abc", ""])
    assert out == [None, None]


def test_sex(spark):
    out, _ = convert(spark, "convert_geslacht", ["M", "V", "O", " "])
    assert out == ["man", "vrouw", "onbekend", "onbekend"]


def test_study_mode(spark):
    out, _ = convert(spark, "convert_opleidingsvorm", ["1", "2", "3", "4", " ", "A"])
    assert out == ["voltijd", "deeltijd", "duaal", "4", None, "A"]


def test_unknown_converter_is_string(spark):
    out, known = convert(spark, "convert_to_mystery", [" x "])
    assert not known and out == ["x"]


def test_registered_converter(spark):
    register_converter("upper_code", get_converter("string")[0].dtype, lambda c: F.upper(c))
    out, known = convert(spark, "upper_code", ["ab ", " "])
    assert known and out == ["AB", None]


@pytest.mark.parametrize("name", ["string", "bigint", "double", "date", "null", "sex", "study_mode",
                                  "bigint_zero_null"])
def test_builtin_names(name):
    assert get_converter(name)[1]


def test_pandas_udf_converter(spark):
    """A converter Spark has no built-in for, as an Arrow-batched pandas UDF."""
    import pandas as pd
    from pyspark.sql import types as T

    @F.pandas_udf(T.StringType())
    def reverse(s: pd.Series) -> pd.Series:
        return s.str[::-1]

    register_converter("reversed_code", T.StringType(), lambda c: reverse(c))
    out, known = convert(spark, "reversed_code", ["abc ", "  "])
    assert known and out == ["cba", None]
