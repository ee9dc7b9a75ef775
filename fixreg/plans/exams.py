"""Exam grades in long form, last attempt per subject."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixreg.functions.codes import OTHER_PRIOR_EDUCATION, classify_prior_education
from fixreg.operators.first_per_key import first_per_key
from fixreg.operators.joins import lookup_join
from fixreg.operators.reshape import unpivot_non_null

PERSON = "PersoonsgebondenNummer"
PRIOR_CODE = "VooropleidingOorspronkelijkeCode"
PRIOR_TEXT = "OmschrijvingVooropleidingOorspronkelijkeCode"

ID_COLUMNS = [PERSON, "Vooropleiding", "Diplomajaar", "VakCode", "VakAfkorting"]
# The grade columns, in the order they are melted.
GRADE_COLUMNS = [
    "CijferEersteCentraalExamen",
    "CijferTweedeCentraalExamen",
    "CijferDerdeCentraalExamen",
    "CijferSchoolexamen",
]
# Attempt number by word in the grade column name (default 1),
# and the exam kind of columns containing "Centraal".
ATTEMPT_BY_WORD = [("Eerste", 1), ("Tweede", 2), ("Derde", 3)]
CENTRAL_WORD, CENTRAL_KIND, SCHOOL_KIND = "Centraal", "CSE", "School"
LAST_ATTEMPT_KEYS = [PERSON, "Vooropleiding", "SoortExamen", "VakAfkorting", "VakCode"]


def add_prior_education(exams: DataFrame, dec_vooropl: DataFrame) -> DataFrame:
    """X1 + X2 label: join the original prior-education code list (row count
    checked).  The short label depends only on the code list's description,
    so it is computed once per code before the join instead of once per exam
    row; an exam row whose code is not listed gets ``overig`` (ledger L22)."""
    codes = dec_vooropl.withColumn("Vooropleiding", classify_prior_education(PRIOR_TEXT))
    j = lookup_join(exams, codes, [PRIOR_CODE], suffix="_vooropl", name="prior-education codes")
    return j.withColumn("Vooropleiding", F.coalesce("Vooropleiding", F.lit(OTHER_PRIOR_EDUCATION)))


def classify(exams: DataFrame) -> DataFrame:
    """Keep the nine columns used later (G7; label added in X1's join)."""
    if "Vooropleiding" not in exams.columns:
        exams = exams.withColumn("Vooropleiding", classify_prior_education(PRIOR_TEXT))
    return exams.select(PERSON, "Diplomajaar", "VakCode", "VakAfkorting", "Vooropleiding", *GRADE_COLUMNS)


def melt_grades(exams: DataFrame) -> DataFrame:
    """X3 + X4: one row per non-missing grade."""
    return unpivot_non_null(exams, ID_COLUMNS, GRADE_COLUMNS, value_type="bigint")


def attempt_and_kind(long: DataFrame) -> DataFrame:
    """Attempt number and exam kind from the grade column name."""
    attempt = None
    for word, n in ATTEMPT_BY_WORD:
        cond = F.col("variable").contains(word)
        attempt = F.when(cond, F.lit(n)) if attempt is None else attempt.when(cond, F.lit(n))
    # Later words win in the reference (each rule overwrites); no name holds two.
    return long.withColumns({
        "Poging": attempt.otherwise(F.lit(1)),
        "SoortExamen": F.when(F.col("variable").contains(CENTRAL_WORD), F.lit(CENTRAL_KIND))
        .otherwise(F.lit(SCHOOL_KIND)),
    })


def last_attempt(graded: DataFrame) -> DataFrame:
    """Highest attempt per (person, prior education, kind, subject);
    ties broken by award year then grade, both descending (ledger L10)."""
    last = first_per_key(graded, LAST_ATTEMPT_KEYS, ["-Poging", "-Diplomajaar", "-value", "variable"])
    return last.withColumnRenamed("value", "Cijfer").drop("variable")


def build_exam_grades(exams: DataFrame, dec_vooropl: DataFrame) -> DataFrame:
    """X1 → X2 → X3/X4 → X5 → X6."""
    return last_attempt(attempt_and_kind(melt_grades(classify(add_prior_education(exams, dec_vooropl)))))
