"""Exam grades: melt, attempt, last attempt (FIXTURES A4; X0–X6)."""

from fixreg.plans.exams import build_exam_grades

SCHEMA = ("PersoonsgebondenNummer string, VooropleidingOorspronkelijkeCode string, Diplomajaar bigint, "
          "VakCode string, VakAfkorting string, CijferEersteCentraalExamen bigint, CijferTweedeCentraalExamen bigint, "
          "CijferDerdeCentraalExamen bigint, CijferSchoolexamen bigint")


def test_last_attempt(spark):
    rows = [
        ("p1", "00401", 2020, "0001", "ne", 6, None, None, 7),    # first attempt only + school
        ("p2", "00401", 2020, "0002", "en", 4, 5, 8, None),       # three attempts → third
        ("p3", "00201", 2020, "0003", "wi", None, None, None, 6),  # school grade only
        ("p4", "00201", 2020, "0004", "bi", None, None, None, None),  # nothing
        ("p5", "00201", 2020, "0005", "gs", 5, None, None, None),  # same key, two award years
        ("p5", "00201", 2021, "0005", "gs", 7, None, None, None),
    ]
    exams = spark.createDataFrame(rows, SCHEMA)
    codes = spark.createDataFrame([("00401", "VWO", "vwo profiel NT"), ("00201", "HAVO", "havo profiel CM")],
                                  "VooropleidingOorspronkelijkeCode string, Onderwijssector string, "
                                  "OmschrijvingVooropleidingOorspronkelijkeCode string")
    out = build_exam_grades(exams, codes)
    got = sorted((r["PersoonsgebondenNummer"], r["SoortExamen"], r["Poging"], r["Cijfer"], r["Vooropleiding"])
                 for r in out.collect())
    assert got == [
        ("p1", "CSE", 1, 6, "vwo"), ("p1", "School", 1, 7, "vwo"),
        ("p2", "CSE", 3, 8, "vwo"),
        ("p3", "School", 1, 6, "havo"),
        ("p5", "CSE", 1, 7, "havo"),  # tie on attempt: later award year wins
    ]
    assert set(out.columns) == {"PersoonsgebondenNummer", "Vooropleiding", "Diplomajaar", "VakCode",
                                "VakAfkorting", "Cijfer", "Poging", "SoortExamen"}
