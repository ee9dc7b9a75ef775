"""Checked lookup joins, membership, first per key (FIXTURES A4; J1–J3, J8, J9, G3)."""

import pytest

from fixreg.operators import (
    CheckFailed,
    anti_join,
    assert_unique,
    duplicate_keys,
    first_per_key,
    lookup_join,
    member_flag,
    require_not_null,
)


def test_lookup_join_matches_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "one"), (None, "nothing"), (7, "x"), (7, "y")], "k int, name string")
    out = {r["v"]: r["name"] for r in lookup_join(left, right, ["k"]).collect()}
    # null matches null; duplicate key 7 matches nothing and passes
    assert out == {"a": "one", "b": None, "c": "nothing"}


def test_lookup_join_duplicate_match_fails(spark):
    left = spark.createDataFrame([(1,)], "k int")
    right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, name string")
    with pytest.raises(Exception, match="matches more than one row"):
        lookup_join(left, right, ["k"], name="dup").collect()
    assert lookup_join(left, right, ["k"], on_duplicate="ignore").count() == 2


def test_lookup_join_suffix_and_keys(spark):
    left = spark.createDataFrame([(1, "L")], "a int, name string")
    right = spark.createDataFrame([(1, "R", "z")], "b int, name string, extra string")
    out = lookup_join(left, right, [("a", "b")], suffix="_r", keep_right_keys=True)
    assert out.columns == ["a", "name", "b", "name_r", "extra"]
    assert out.collect()[0]["name_r"] == "R"


def test_not_null_safe(spark):
    left = spark.createDataFrame([(None, "c")], "k int, v string")
    right = spark.createDataFrame([(None, "nothing")], "k int, name string")
    assert lookup_join(left, right, ["k"], null_safe=False).collect()[0]["name"] is None


def test_assert_unique_and_require(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(CheckFailed):
        assert_unique(df, ["k"])
    with pytest.raises(CheckFailed):
        assert_unique(spark.createDataFrame([(None,)], "k int"), ["k"])
    with pytest.raises(Exception, match="missing"):
        require_not_null(spark.createDataFrame([(None,)], "k int"), "k").collect()
    assert duplicate_keys(df, ["k"]).collect()[0]["n_rows"] == 2


def test_member_flag_and_anti_join(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    flags = {r["k"]: r["hit"] for r in member_flag(left, right, ["k"], "hit").collect()}
    assert flags == {1: 1, 2: 0, None: 1}
    assert [r["k"] for r in anti_join(left, right, ["k"]).collect()] == [2]


def test_first_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("p", 2020, "b"), ("p", 2020, "a"), ("p", None, "c"), ("q", None, "d"), ("r", 2019, "e")],
        "k string, yr int, tie string")
    out = {r["k"]: (r["yr"], r["tie"]) for r in first_per_key(df, ["k"], ["yr"]).collect()}
    assert out == {"p": (2020, "a"), "q": (None, "d"), "r": (2019, "e")}
    last = {r["k"]: r["yr"] for r in first_per_key(df, ["k"], ["-yr"]).collect()}
    assert last["p"] == 2020  # nulls last also when descending


def test_first_per_key_limits_before_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = first_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit")
    assert "Partial" in plan and "Final" in plan
    assert plan.rfind("Exchange") > partial or "Partial" in plan[plan.rfind("Exchange"):]


def test_lookup_join_output_collision_is_reported(spark):
    left = spark.createDataFrame([(1, "a", "x")], "k int, name string, name_r string")
    right = spark.createDataFrame([(1, "b")], "k int, name string")
    with pytest.raises(CheckFailed, match="already exist"):
        lookup_join(left, right, ["k"], suffix="_r")
