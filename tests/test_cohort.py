"""Cohort indicators on hand-made enrolments (FIXTURES A4/A5; K1–K15)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixreg.plans import cohort as K

COLS = ["PersoonsgebondenNummer", "Inschrijvingsjaar", "EersteJaarAanDezeActueleInstelling",
        "IndicatieActiefOpPeildatum", "SoortInschrijvingHogerOnderwijs", "ActueleInstelling", "opleiding",
        "OpleidingActueelEquivalent", "Opleidingsvorm", "Diplomajaar", "OpleidingsfaseActueelVanHetDiploma",
        "DatumTekeningDiploma", "HoDiplomaInEersteJaar", "Aantal", "InPACohortDefinitie",
        "TypeHogerOnderwijsBinnenSoortHogerOnderwijs"]
SCHEMA = ("PersoonsgebondenNummer string, Inschrijvingsjaar bigint, EersteJaarAanDezeActueleInstelling bigint, "
          "IndicatieActiefOpPeildatum bigint, SoortInschrijvingHogerOnderwijs string, ActueleInstelling string, "
          "opleiding string, OpleidingActueelEquivalent string, Opleidingsvorm string, Diplomajaar bigint, "
          "OpleidingsfaseActueelVanHetDiploma string, DatumTekeningDiploma date, HoDiplomaInEersteJaar int, "
          "Aantal int, InPACohortDefinitie string, TypeHogerOnderwijsBinnenSoortHogerOnderwijs string")


def row(pgn, yr, first=2020, inst="21XX", prog="34560", award=None, phase=None, degree=0, main="1", active=1):
    d = dict(PersoonsgebondenNummer=pgn, Inschrijvingsjaar=yr, EersteJaarAanDezeActueleInstelling=first,
             IndicatieActiefOpPeildatum=active, SoortInschrijvingHogerOnderwijs=main, ActueleInstelling=inst,
             opleiding=prog, OpleidingActueelEquivalent=prog, Opleidingsvorm="voltijd", Diplomajaar=award,
             OpleidingsfaseActueelVanHetDiploma=phase,
             DatumTekeningDiploma=dt.date(award, 7, 1) if award else None, HoDiplomaInEersteJaar=degree,
             Aantal=1, InPACohortDefinitie="Ja", TypeHogerOnderwijsBinnenSoortHogerOnderwijs="ba")
    return tuple(d[c] for c in COLS)


ROWS = [
    row("A", 2020), row("A", 2021),                                   # stays, same programme
    row("B", 2020), row("B", 2021, prog="39120"),                     # switch inside institution
    row("C", 2020), row("C", 2021, inst="99YY"),                      # other institution: drop-out
    row("D", 2020),                                                   # nothing in year 2
    row("E", 2020, degree=1), row("E", 2021, inst="99YY"),            # degree in first year wins
    row("F", 2020, award=2020, phase="D"), row("F", 2021), row("F", 2023, award=2023, phase="B"),
    row("G", 2020), row("G", 2021, award=2021, phase="D", inst="99YY"), row("G", 2025, award=2025, phase="B",
                                                                              prog="39120"),
    row("H", 2020, main="2"),                                         # not a main enrolment: no intake
    row("I", 2020, active=0),                                         # not active: no intake
]


@pytest.fixture(scope="module")
def cohort(spark):
    enr = spark.createDataFrame(ROWS, SCHEMA)
    return {r["PersoonsgebondenNummer"]: r for r in K.build_cohort(enr).collect()}


def test_intake_filter(cohort):
    assert sorted(cohort) == list("ABCDEFG")


def test_retention_and_status(cohort):
    expect = {  # Uitval, opleiding_gelijk, Herinschrijving, Switch, status
        "A": (0, 1, 1, 0, "StudeertNogAanHsl"),
        "B": (0, 0, 1, 1, "SwitchBinnenInstelling"),
        "C": (1, 1, 0, 0, "ValtUitInJaar1"),
        "D": (1, 0, 0, 0, "ValtUitInJaar1"),
        "E": (0, 1, 0, 0, "HoDiplomaInEersteJaar"),
    }
    for p, e in expect.items():
        r = cohort[p]
        got = (r["UitvalEerstejaar"], r["opleiding_gelijk"], r["HerinschrijvingInstelling"],
               r["SwitchBinnenInstelling"], r["StatusNa1Jaar"])
        assert got == e, p


def test_propaedeutic_flags(cohort):
    assert (cohort["F"]["PropedeuseIn1Jaar"], cohort["F"]["PropedeuseIn2Jaar"]) == (1, 1)
    assert (cohort["G"]["PropedeuseIn1Jaar"], cohort["G"]["PropedeuseIn2Jaar"]) == (0, 1)
    assert cohort["F"]["HerinschrijvingMetPropedeuse"] == 1
    assert cohort["A"]["PropedeuseIn2Jaar"] == 0


def test_time_to_award(cohort):
    f, g = cohort["F"], cohort["G"]
    assert (f["BachelorDiploma"], f["JaarTotEenDiploma"]) == (1, 3)
    assert [f[f"EenDiplomaBinnen{n}jaar"] for n in (4, 5, 6, 7, 8)] == [1, 1, 1, 1, 1]
    assert g["JaarTotEenDiploma"] == 5
    assert [g[f"EenDiplomaBinnen{n}jaar"] for n in (4, 5, 6, 7, 8)] == [0, 0, 1, 1, 1]
    assert cohort["A"]["BachelorDiploma"] == 0 and cohort["A"]["JaarTotEenDiploma"] is None
    # same-programme award: G's bachelor is in another programme
    assert f["Diplomajaar_DitDiploma"] == 2023 and g["Diplomajaar_DitDiploma"] is None


def test_flags_are_binary_and_monotone(cohort):
    for r in cohort.values():
        within = [r[f"EenDiplomaBinnen{n}jaar"] for n in (4, 5, 6, 7, 8)]
        assert set(within) <= {0, 1} and within == sorted(within)


def test_final_columns(cohort):
    assert cohort["A"]["Cohort"] == 2020 and cohort["A"]["CohortType"] == "EersteKeerHO"
    assert cohort["A"]["TypeOpleiding"] == "bachelor"


def test_lazy_and_materialized_agree(spark):
    enr = spark.createDataFrame(ROWS, SCHEMA)
    a = sorted(map(tuple, K.build_cohort(enr, materialize=False).collect()))
    b = sorted(map(tuple, K.build_cohort(enr, materialize=True).collect()))
    assert a == b


def test_second_year_duplicate_fails(spark):
    enr = spark.createDataFrame([row("X", 2020), row("X", 2021), row("X", 2021, prog="39120")], SCHEMA)
    with pytest.raises(Exception, match="more than one row"):
        K.build_cohort(enr).collect()


def test_observed_until_censors(spark):
    enr = spark.createDataFrame(ROWS, SCHEMA)
    out = {r["PersoonsgebondenNummer"]: r for r in K.build_cohort(enr, observed_until=2020).collect()}
    assert out["D"]["UitvalEerstejaar"] is None


def test_every_intake_column_is_carried(spark):
    enr = spark.createDataFrame(ROWS, SCHEMA).withColumn("Iets", F.lit("x"))
    out = K.build_cohort(enr)
    assert set(enr.columns) <= set(out.columns)


def test_hot_person_is_split_and_nothing_is_broadcast_by_force(spark):
    # person "Z" is enrolled in 20,000 programmes in its first year: a third of all rows
    n = 20_000
    base = spark.createDataFrame([row("Z", 2020)], SCHEMA)
    ids = spark.range(2 * n).select(F.concat(F.lit("P"), F.expr("id div 2")).alias("p"), (F.lit(2020) + F.col("id") % 2).alias("y"))
    others = base.drop("PersoonsgebondenNummer", "Inschrijvingsjaar").crossJoin(ids).withColumnsRenamed({"p": "PersoonsgebondenNummer", "y": "Inschrijvingsjaar"})
    hot = base.drop("opleiding").crossJoin(spark.range(n).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("opleiding")))
    enr = others.select(base.columns).unionByName(hot.select(base.columns)).unionByName(spark.createDataFrame([row("Z", 2021)], SCHEMA))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = K.build_cohort(enr.repartition(6))
        assert out.count() == 2 * n
        out = out.select("PersoonsgebondenNummer", "StatusNa1Jaar")
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "BroadcastHashJoin" not in plan
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_person_facts_equal_the_separate_operators(spark):
    """One aggregate against second year, propaedeutic and first award one by one, with nulls and ties."""
    import random

    r = random.Random(71)
    rows = []
    for p in range(120):
        rows.append(row(f"p{p}", 2020))
        if r.random() < 0.6:
            rows.append(row(f"p{p}", 2021, inst=r.choice(["21XX", "99YY", None]), prog=r.choice(["34560", "39120", None])))
        for _ in range(r.randint(0, 4)):
            rows.append(row(f"p{p}", 2024, first=r.choice([2019, 2020, None]), prog=r.choice(["34560", "39120", None]), award=r.choice([2020, 2021, 2022, None]),
                            phase=r.choice(["D", "B", "B", None]), main="2"))
    enr = spark.createDataFrame(rows + [row("only", 2024, award=2022, phase="B", main="2")], SCHEMA)
    got = {x[K.PERSON]: x for x in K.person_facts(enr).collect()}
    assert sorted(got) == sorted(f"p{p}" for p in range(120))
    second = {x[K.PERSON]: x for x in K.second_year(enr).collect()}
    years = {x["__pp"]: x for x in K.propaedeutic_years(K.first_propaedeutic(enr)).collect()}
    award = {x[K.PERSON]: x for x in K.first_award(K.bachelor_awards(enr)).collect()}
    for p, x in got.items():
        for c in (K.PROGRAMME, K.INSTITUTION, K.MODE, K.CURRENT_CODE):
            assert x[c + K.YEAR2_SUFFIX] == (second[p][c] if p in second else None)
        assert (x["__p1"], x["__p2"]) == ((years[p]["__p1"], years[p]["__p2"]) if p in years else (None, None))
        for c in (K.CURRENT_CODE, K.PROGRAMME, K.AWARD_DATE, K.AWARD_YEAR, K.MODE, "Aantal"):
            assert x[c + K.ANY_AWARD_SUFFIX] == (award[p][c] if p in award else None)
    assert len(second) > 40 and len(years) > 20 and len(award) > 50


def test_person_facts_take_one_exchange(spark):
    plan = K.person_facts(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and f"hashpartitioning({K.PERSON}" in plan and "Join" not in plan and "Window" not in plan
    assert "partial_min" in plan.split("Exchange ")[1]  # minima are taken before it
