"""Student cohorts with first-year indicators.

Input: the enriched enrolment table (one row per person, year, programme).
Every join and window below is keyed by the person id.  Each right side is unique per key by construction (``first_per_key``) except the
second-year table, whose uniqueness is checked inside its join (J1).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.functions.codes import COHORT_TYPE_BY_FLAG, LEVEL_BY_HE_TYPE
from fixreg.functions.exprs import as_int, eq, fail_if, flag, recode, truthy
from fixreg.operators.first_per_key import first_per_key
from fixreg.operators.joins import CheckFailed, lookup_join, require_columns
from fixreg.session import ScratchSpace, session_space

PERSON = "PersoonsgebondenNummer"
YEAR = "Inschrijvingsjaar"
FIRST_YEAR = "EersteJaarAanDezeActueleInstelling"
INSTITUTION = "ActueleInstelling"
PROGRAMME = "opleiding"
CURRENT_CODE = "OpleidingActueelEquivalent"
MODE = "Opleidingsvorm"
AWARD_YEAR = "Diplomajaar"
AWARD_PHASE = "OpleidingsfaseActueelVanHetDiploma"
AWARD_DATE = "DatumTekeningDiploma"
FIRST_YEAR_DEGREE = "HoDiplomaInEersteJaar"

YEAR2_SUFFIX = "_2ejaar"
ANY_AWARD_SUFFIX = "_EenDiploma"
SAME_AWARD_SUFFIX = "_DitDiploma"
# Fixed values: "award within N years" thresholds (N → years after first year).
WITHIN_YEARS = (4, 5, 6, 7, 8)

REQUIRED = [PERSON, YEAR, FIRST_YEAR, "IndicatieActiefOpPeildatum", "SoortInschrijvingHogerOnderwijs",
            INSTITUTION, PROGRAMME, CURRENT_CODE, MODE, AWARD_YEAR, AWARD_PHASE, AWARD_DATE,
            FIRST_YEAR_DEGREE, "Aantal", "InPACohortDefinitie", "TypeHogerOnderwijsBinnenSoortHogerOnderwijs"]

NUMERIC = [YEAR, FIRST_YEAR, "IndicatieActiefOpPeildatum", FIRST_YEAR_DEGREE]


def is_main_enrolment(df_col: str = "SoortInschrijvingHogerOnderwijs"):
    # Stored as text in the layout; compare as a number (ledger L1).
    return truthy(as_int(df_col) == 1)


# The roles a row of the enriched table can have (K1, K2, K3, K5).
def in_intake() -> Column:
    return truthy(F.col("IndicatieActiefOpPeildatum") == 1) & is_main_enrolment() & eq(YEAR, FIRST_YEAR)


def in_second_year() -> Column:
    return eq(YEAR, F.col(FIRST_YEAR) + 1) & is_main_enrolment()


def has_propaedeutic() -> Column:
    return F.col(AWARD_YEAR).isNotNull() & eq(AWARD_PHASE, F.lit("D"))


def has_bachelor() -> Column:
    return F.coalesce(F.col(AWARD_YEAR) != 0, F.lit(True)) & eq(AWARD_PHASE, F.lit("B"))


def intake(enr: DataFrame) -> DataFrame:
    """K1: active on the reference date, main enrolment, first year at the institution."""
    return enr.filter(in_intake())


def second_year(enr: DataFrame) -> DataFrame:
    """K2: main enrolments in the year after the first year at the institution
    (G6 filter, G7 projection, G12 year arithmetic)."""
    return enr.filter(in_second_year()).select(PERSON, PROGRAMME, INSTITUTION, MODE, CURRENT_CODE)


def first_propaedeutic(enr: DataFrame) -> DataFrame:
    """K3: earliest propaedeutic diploma per person."""
    p = enr.filter(has_propaedeutic()).select(
        PERSON, CURRENT_CODE, FIRST_YEAR, AWARD_DATE, PROGRAMME, AWARD_YEAR
    )
    return first_per_key(p, [PERSON], [AWARD_YEAR, AWARD_DATE, PROGRAMME]).withColumnRenamed(
        AWARD_YEAR, "JaarPropedeuseDiploma"
    )


def bachelor_awards(enr: DataFrame) -> DataFrame:
    """K5: bachelor diplomas; a missing award year passes ``!= 0`` (ledger L9)."""
    return enr.filter(has_bachelor()).select(
        PERSON, CURRENT_CODE, PROGRAMME, AWARD_DATE, AWARD_YEAR, MODE, "Aantal"
    )


def attach_second_year(cohort: DataFrame, year2: DataFrame) -> DataFrame:
    """K4 (J6): intake ⟕ second year on person; a person with two
    second-year rows fails the check instead of duplicating the intake row."""
    return lookup_join(cohort, year2, [PERSON], suffix=YEAR2_SUFFIX, null_safe=False,
                       name="second-year enrolment")


def add_retention_flags(df: DataFrame) -> DataFrame:
    """K9 drop-out, K10 ``opleiding_gelijk``, K11 re-enrolled at the
    institution (the rule that takes effect, ledger L16), K12 switch."""
    same_inst = eq(INSTITUTION, INSTITUTION + YEAR2_SUFFIX)
    degree = truthy(F.col(FIRST_YEAR_DEGREE) == 1)
    same_prog = eq(PROGRAMME, PROGRAMME + YEAR2_SUFFIX) | eq(CURRENT_CODE, CURRENT_CODE + YEAR2_SUFFIX)
    dropout = ~(same_inst | degree)
    return df.withColumns({
        "UitvalEerstejaar": flag(dropout),
        "opleiding_gelijk": flag(same_prog),
        "HerinschrijvingInstelling": flag(same_inst),
        "SwitchBinnenInstelling": flag(~same_prog & ~dropout & ~degree),
    })


def propaedeutic_years(propaedeutic: DataFrame) -> DataFrame:
    """Per person: was the propaedeutic diploma in its row's first year, or the second?"""
    return propaedeutic.select(
        F.col(PERSON).alias("__pp"),
        eq(F.col("JaarPropedeuseDiploma"), F.col(FIRST_YEAR)).alias("__p1"),
        eq(F.col("JaarPropedeuseDiploma"), F.col(FIRST_YEAR) + 1).alias("__p2"),
    )


def add_propaedeutic_flags(df: DataFrame, propaedeutic: DataFrame) -> DataFrame:
    """K6: propaedeutic in year 1 / within 2 years, judged on the diploma
    row's own first year; drop-out with propaedeutic."""
    p = propaedeutic_years(propaedeutic)
    return _propaedeutic_flags(df.join(p, F.col(PERSON) == F.col("__pp"), "left").drop("__pp"))


def _propaedeutic_flags(df: DataFrame) -> DataFrame:
    p1 = truthy(F.col("__p1"))
    return df.withColumns({
        "PropedeuseIn1Jaar": flag(p1),
        "PropedeuseIn2Jaar": flag(p1 | truthy(F.col("__p2"))),
        "Uitval1JaarMetPropedeuse": flag((F.col("UitvalEerstejaar") == 1) & p1),
    }).drop("__p1", "__p2")


def add_reenrolled_with_propaedeutic(df: DataFrame) -> DataFrame:
    """K13."""
    return df.withColumn(
        "HerinschrijvingMetPropedeuse",
        flag((F.col("HerinschrijvingInstelling") == 1) & (F.col("PropedeuseIn1Jaar") == 1)),
    )


def add_first_award(df: DataFrame, awards: DataFrame) -> DataFrame:
    """K7 (J7): first bachelor diploma of any programme; years to it; within-N flags.

    A diploma before the first year gives a negative count, which counts as
    "within" every threshold (ledger L23).
    """
    return _award_flags(lookup_join(df, first_award(awards), [PERSON], suffix=ANY_AWARD_SUFFIX, null_safe=False, on_duplicate="ignore"))


def first_award(awards: DataFrame) -> DataFrame:
    return first_per_key(awards, [PERSON], [AWARD_YEAR, AWARD_DATE, PROGRAMME, CURRENT_CODE])


def _award_flags(df: DataFrame) -> DataFrame:
    years = F.col(AWARD_YEAR + ANY_AWARD_SUFFIX) - F.col(FIRST_YEAR)
    cols = {
        "BachelorDiploma": F.coalesce(F.col("Aantal" + ANY_AWARD_SUFFIX), F.lit(0)),
        "JaarTotEenDiploma": years,
    }
    for n in WITHIN_YEARS:
        cols[f"EenDiplomaBinnen{n}jaar"] = flag(years <= n - 1)
    return df.withColumns(cols)


def first_award_by_programme(awards: DataFrame) -> DataFrame:
    return first_per_key(awards, [PERSON, PROGRAMME], [AWARD_YEAR, AWARD_DATE, CURRENT_CODE])


def add_same_programme_award(df: DataFrame, awards: DataFrame) -> DataFrame:
    """K8 (J7): first bachelor diploma of the intake programme (null-safe on the
    programme; the person is never null here)."""
    return _with_same_programme(df, first_award_by_programme(awards))


def _with_same_programme(df: DataFrame, first: DataFrame) -> DataFrame:
    return lookup_join(df, first, [PERSON, PROGRAMME], suffix=SAME_AWARD_SUFFIX, on_duplicate="ignore", null_safe=[PROGRAMME])


def add_status(df: DataFrame, column: str = "StatusNa1Jaar") -> DataFrame:
    """The last matching rule of degree / switch / drop-out wins; the
    unreachable "diploma obtained" status is not produced (ledger L17)."""
    status = (
        F.when(F.col(FIRST_YEAR_DEGREE) == 1, F.lit("HoDiplomaInEersteJaar"))
        .when(F.col("SwitchBinnenInstelling") == 1, F.lit("SwitchBinnenInstelling"))
        .when(F.col("UitvalEerstejaar") == 1, F.lit("ValtUitInJaar1"))
        .otherwise(F.lit("StudeertNogAanHsl"))
    )
    return df.withColumn(column, status)


def finalize(df: DataFrame) -> DataFrame:
    """Cohort year, cohort type and programme level (replaces E10's
    ``TypeOpleiding`` in this table, ledger L18)."""
    return df.withColumns({
        "Cohort": F.col(YEAR),
        "CohortType": recode("InPACohortDefinitie", COHORT_TYPE_BY_FLAG),
        "TypeOpleiding": recode("TypeHogerOnderwijsBinnenSoortHogerOnderwijs", LEVEL_BY_HE_TYPE),
    })


def censor_unobserved(df: DataFrame, observed_until: int) -> DataFrame:
    """Set year-2 based indicators to null for cohorts whose second year lies
    after ``observed_until`` (ledger L24, off by default)."""
    late = F.col(YEAR) + 1 > F.lit(observed_until)
    cols = ["UitvalEerstejaar", "opleiding_gelijk", "HerinschrijvingInstelling", "SwitchBinnenInstelling",
            "Uitval1JaarMetPropedeuse", "HerinschrijvingMetPropedeuse", "StatusNa1Jaar"]
    return df.withColumns({c: F.when(~late, F.col(c)) for c in cols if c in df.columns})


def _prepared(enr: DataFrame) -> DataFrame:
    require_columns(enr, REQUIRED, "cohort input")
    untyped = [c for c in NUMERIC if not isinstance(enr.schema[c].dataType, T.NumericType)]
    if untyped:  # ledger L32: the untyped scan mode cannot feed the cohort
        raise CheckFailed(f"cohort input: numeric columns read as text: {untyped}")
    return enr.filter(fail_if(F.col(PERSON).isNull(), f"cohort input: {PERSON} is null"))


def _row(*columns: str) -> Column:
    """Columns as one value that sorts by them, nulls last."""
    return F.struct(*[x for c in columns for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))])


def person_facts(enr: DataFrame) -> DataFrame:
    """What the cohort takes per person, for every person of the intake: second
    year (its uniqueness checked, J1), propaedeutic, first award (K2, K3, K7).

    One conditional aggregate: a row counts for each role it has, and each
    role keeps the least row in its order.  Rows without a role are filtered
    at the scan; minima and counts are taken map-side, so a hot person ships
    one row per map task, through the only exchange."""
    roles = {"intake": in_intake(), "second": in_second_year(), "first_p": has_propaedeutic(), "award": has_bachelor()}
    least = {
        "second": _row(PROGRAMME, INSTITUTION, MODE, CURRENT_CODE),
        "first_p": _row(AWARD_YEAR, AWARD_DATE, PROGRAMME, CURRENT_CODE, FIRST_YEAR),
        "award": _row(AWARD_YEAR, AWARD_DATE, PROGRAMME, CURRENT_CODE, MODE, "Aantal"),
    }
    wanted = reduce(lambda a, b: a | b, roles.values())
    facts = enr.filter(wanted).groupBy(PERSON).agg(
        F.count_if(roles["intake"]).alias("__intakes"), F.count_if(roles["second"]).alias("__seconds"),
        *[F.min(F.when(roles[r], row)).alias(f"__{r}") for r, row in least.items()])
    facts = facts.filter(F.col("__intakes") > 0).filter(
        fail_if(F.col("__seconds") > 1, f"second-year enrolment: a key ({PERSON}) matches more than one row"))
    year = F.col(f"__first_p.{AWARD_YEAR}")
    return facts.select(
        PERSON,
        *[F.col(f"__second.{c}").alias(c + YEAR2_SUFFIX) for c in (PROGRAMME, INSTITUTION, MODE, CURRENT_CODE)],
        *[F.when(F.col("__first_p").isNotNull(), eq(year, F.col(f"__first_p.{FIRST_YEAR}") + n)).alias(f"__p{n + 1}") for n in (0, 1)],
        *[F.col(f"__award.{c}").alias(c + ANY_AWARD_SUFFIX) for c in (CURRENT_CODE, PROGRAMME, AWARD_DATE, AWARD_YEAR, MODE, "Aantal")],
    )


def _indicators(enr: DataFrame, keep) -> DataFrame:
    facts, same = keep(person_facts(enr), "cohort-persons"), keep(first_award_by_programme(bachelor_awards(enr)), "cohort-awards")
    base = intake(enr).join(facts, PERSON, "left")
    base = add_reenrolled_with_propaedeutic(_propaedeutic_flags(add_retention_flags(base)))
    return finalize(add_status(_with_same_programme(_award_flags(base), same)))


def build_cohort(enr: DataFrame, *, observed_until: int | None = None, materialize: bool = True, stored: bool = False,
                 scratch: ScratchSpace | None = None) -> DataFrame:
    """The cohort table: K1 → K4 → K9–K12 → K6 → K13 → K7 → K8 → K14 → K15.

    Every column of the intake row is carried, and the indicators are added.
    With ``materialize`` (default) the input (unless it is ``stored`` already)
    and the two right sides are written as tables of ``scratch`` (default: the
    session's space): the enrichment runs once instead of once per branch, a
    lost executor costs a re-read, and the intake meets each right side in a
    plain join of two shuffled tables.  Close the space once the cohort is
    written.

    A person with very many rows stays cheap: the right sides hold one row
    per person (or person and programme) and are limited map-side before the
    shuffle, and the skew split of the join divides the person's intake rows.
    """
    base = _prepared(enr)
    scratch = scratch or (session_space(enr.sparkSession) if materialize else None)
    if materialize and not stored:
        base = scratch.write(base, "cohort-input")
    out = _indicators(base, scratch.write if materialize else lambda df, _: df)
    if observed_until is not None:
        out = censor_unobserved(out, observed_until)
    return out
