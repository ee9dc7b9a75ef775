"""One key holding a third of all rows: results stay whole and correct, and
the plans reduce that key before the shuffle instead of shipping its group."""

from pyspark.sql import functions as F

from fixreg.operators import first_per_key, lookup_join, member_flag
from fixreg.plans.exams import build_exam_grades

N = 3000


def hot(spark, n=N):
    # key 0 holds a third of the rows; the rest are spread over 1000 keys
    return spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 1000 + 1 END AS k", "id AS v")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_per_key_hot_key(spark):
    out = {r["k"]: r["v"] for r in first_per_key(hot(spark), ["k"], ["-v"]).collect()}
    assert out[0] == N - 3 and len(out) == 1001
    plan = plan_of(first_per_key(hot(spark), ["k"], ["-v"]))
    assert "Partial" in plan.split("Exchange")[-1]  # partial limit below the exchange


def test_member_flag_hot_right_key(spark):
    left = spark.range(5).selectExpr("id AS k")
    flags = {r["k"]: r["hit"] for r in member_flag(left, hot(spark), ["k"], "hit").collect()}
    assert flags == {0: 1, 1: 1, 2: 1, 3: 1, 4: 1}
    plan = plan_of(member_flag(left, hot(spark), ["k"], "hit"))
    below = plan.split("Exchange")[-1]
    assert "HashAggregate" in below  # keys de-duplicated before the shuffle


def test_lookup_join_hot_left_key(spark):
    right = spark.range(1002).selectExpr("id AS k", "CAST(id AS STRING) AS name")
    out = lookup_join(hot(spark), right, ["k"]).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("name"))
    rows = {r["k"]: r["n"] for r in out.collect()}
    assert rows[0] == N // 3 and sum(rows.values()) == N


def test_exam_grades_hot_person(spark):
    rows = [("p0" if i % 3 == 0 else f"p{i}", "00401", 2020, f"{i % 7:04d}", "ne", i % 9 + 1, None, None, i % 5 + 1)
            for i in range(900)]
    exams = spark.createDataFrame(rows, "PersoonsgebondenNummer string, VooropleidingOorspronkelijkeCode string, "
                                        "Diplomajaar bigint, VakCode string, VakAfkorting string, "
                                        "CijferEersteCentraalExamen bigint, CijferTweedeCentraalExamen bigint, "
                                        "CijferDerdeCentraalExamen bigint, CijferSchoolexamen bigint")
    codes = spark.createDataFrame([("00401", "VWO", "vwo")], "VooropleidingOorspronkelijkeCode string, "
                                  "Onderwijssector string, OmschrijvingVooropleidingOorspronkelijkeCode string")
    out = build_exam_grades(exams, codes).filter("PersoonsgebondenNummer = 'p0'").collect()
    # p0 has 300 rows over 7 subjects: one CSE and one school grade per subject, highest grade wins the tie
    assert len(out) == 14
    assert {(r["VakCode"], r["SoortExamen"]) for r in out} == {(f"{s:04d}", k) for s in range(7) for k in ("CSE", "School")}
    best = {}
    for i in range(0, 900, 3):
        key = f"{i % 7:04d}"
        best[key] = max(best.get(key, 0), i % 9 + 1)
    assert {r["VakCode"]: r["Cijfer"] for r in out if r["SoortExamen"] == "CSE"} == best


def test_anti_join_hot_right_key_is_deduplicated_before_the_shuffle(spark):
    from fixreg.operators.joins import anti_join

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k")
        out = anti_join(spark.range(4000).toDF("k"), right, ["k"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and plan.count("HashAggregate(keys=[") == 2  # partial and final, over the right keys
        assert out.count() == 4000 - 2000 - 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
