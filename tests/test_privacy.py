"""Pseudonymisation: crosswalk bijection, consistency, blanking."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixreg.operators import add_local_id, blank_columns, crosswalk, global_rank, pseudonymise

SALT = "test-salt"


def test_global_rank_equals_row_number(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("CAST((id * 7919) % 5003 AS STRING) AS s").distinct()
    got = global_rank(df, ["s"]).collect()
    expect = df.select("s", F.row_number().over(Window.orderBy("s")).alias("rank")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expect))


def test_crosswalk_is_bijection_with_padding(spark):
    ids = spark.createDataFrame([("12345",), ("1234567",), ("000000000017",), ("12345",)], "PersoonsgebondenNummer string")
    xw = crosswalk(ids, salt=SALT).collect()
    assert len(xw) == 3
    olds = {r[0] for r in xw}
    news = {r[1] for r in xw}
    assert {n.lstrip("0") for n in news} == {o.lstrip("0") for o in olds}
    assert all(len(n) >= 7 for n in news) and "000000000017" in news


def test_crosswalk_null_id_fails(spark):
    ids = spark.createDataFrame([("1",), (None,)], "PersoonsgebondenNummer string")
    with pytest.raises(Exception, match="null"):
        crosswalk(ids, salt=SALT).collect()


def test_pseudonymise_consistent_across_tables(spark):
    enr = spark.createDataFrame([("0000001", "123456789", 2020), ("0000002", "987654321", 2021)],
                                "PersoonsgebondenNummer string, Burgerservicenummer string, jaar int")
    exams = spark.createDataFrame([("0000001", 7), ("0000003", 8)], "PersoonsgebondenNummer string, cijfer int")
    for mode in ("permute", "hash"):
        out = pseudonymise({"enr": enr, "exams": exams}, salt=SALT, mode=mode)
        e = {r["jaar"]: r["PersoonsgebondenNummer"] for r in out["enr"].collect()}
        x = {r["cijfer"]: r["PersoonsgebondenNummer"] for r in out["exams"].collect()}
        assert e[2020] == x[7]  # same person, same pseudo id
        assert x[8] is not None  # exam-only person keeps a pseudo id (L14)
        assert all(r["Burgerservicenummer"] is None for r in out["enr"].collect())
        assert out["enr"].schema["Burgerservicenummer"].dataType.simpleString() == "string"


def test_salt_required(spark):
    with pytest.raises(ValueError):
        pseudonymise({"t": spark.createDataFrame([("1",)], "PersoonsgebondenNummer string")}, salt="")


def test_blank_columns_keeps_type(spark):
    df = spark.createDataFrame([(1, 2)], "Onderwijsnummer bigint, x int")
    out = blank_columns(df)
    assert out.collect()[0]["Onderwijsnummer"] is None and out.schema["Onderwijsnummer"].dataType.simpleString() == "bigint"


def test_add_local_id(spark):
    df = spark.createDataFrame([("1",), ("2",)], "pgn string")
    local = spark.createDataFrame([("1", "S1")], "pgn_l string, studentnummer string")
    out = {r["pgn"]: r["studentnummer"] for r in add_local_id(df, local, "pgn", "pgn_l").collect()}
    assert out == {"1": "S1", "2": None}
    dup = spark.createDataFrame([("1", "S1"), ("1", "S9")], "pgn_l string, studentnummer string")
    with pytest.raises(Exception, match="more than one row"):
        add_local_id(df, dup, "pgn", "pgn_l").collect()


def test_crosswalk_padding_collision_fails(spark):
    ids = spark.createDataFrame([("12345",), ("0012345",), ("99",)], "PersoonsgebondenNummer string")
    with pytest.raises(Exception, match="zero-padding"):
        crosswalk(ids, salt=SALT)

