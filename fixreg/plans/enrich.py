"""Enriched enrolments.

A chain of ``DataFrame.transform`` steps: recodes are literal-map
expressions (G1, with G8 defaults), lookups are checked left joins (J5,
broadcast when Spark's size check allows).  The lookups are passed in
explicitly (ledger L27); right columns that clash are suffixed and only
those are dropped (L28).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fixreg.functions.codes import (
    classify_prior_education,
    diploma_kind_of,
    profile_of,
    programme_type_of,
    sector_of,
)
from fixreg.functions.exprs import as_int, eq, flag, label, truthy, zero_pad
from fixreg.operators.joins import (
    CheckFailed,
    anti_join,
    joined_name,
    lookup_join,
    require_columns,
    require_not_null,
)

log = logging.getLogger(__name__)

PRIOR_KINDS = ("HoogsteVooropleiding", "HoogsteVooroplVoorHetHo", "HoogsteVooroplBinnenHetHo")
UNKNOWN = "onbekend"
MATCHED = "__matched"
# Codes without a local name are noted in bitmaps: this many of this many bits cover numbers of five digits.
BITMAPS, BITS = 4, 32768


@dataclass
class Lookups:
    """Code lists used by the enrichment (all small, read from Parquet)."""

    dec_vopl: DataFrame  # VooropleidingCode, OmschrijvingVooropleiding
    dec_brinvestigingsnummer: DataFrame  # Brinnummer, Vestigingsnummer, 7 attributes
    dec_isat: DataFrame  # Opleidingscode, NaamOpleiding
    dec_ho_isced: DataFrame  # Opleidingscode (bigint), ISCED columns
    local_names: DataFrame | None = None  # Opleidingscode;CodeOpleiding;NaamOpleiding;NaamFaculteit;CodeFaculteit


def added_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns a step added (schema only, no job)."""
    return [c for c in after.columns if c not in set(before.columns)]


def prior_education_codes(dec_vopl: DataFrame) -> DataFrame:
    """E2 + E1 on the prior-education code list: profile and short label."""
    return dec_vopl.withColumns({
        "ProfielVooropleiding": profile_of("VooropleidingCode"),
        "Vooropleiding": classify_prior_education("OmschrijvingVooropleiding"),
    })


def add_prior_education(enr: DataFrame, dec_vopl: DataFrame, field: str = "HoogsteVooropleiding") -> DataFrame:
    """Join the code list on ``field``; adds ``{field}Code``, ``{field}Volledig``,
    ``{field}Profiel`` and ``Vooropleiding`` (ledger L31)."""
    codes = prior_education_codes(dec_vopl)
    j = lookup_join(enr, codes, [(field, "VooropleidingCode")], suffix="_Vooropleiding", keep_right_keys=True,
                    name="prior-education code list")
    return j.withColumnsRenamed({
        joined_name(enr, "OmschrijvingVooropleiding", "_Vooropleiding"): field + "Volledig",
        joined_name(enr, "ProfielVooropleiding", "_Vooropleiding"): field + "Profiel",
        joined_name(enr, "VooropleidingCode", "_Vooropleiding"): field + "Code",
    })


def add_prior_institution(enr: DataFrame, register: DataFrame, kind: str = "HoogsteVooropleiding") -> DataFrame:
    """Name and attributes of the school of the prior education, on
    (institution, location); attribute columns carry the kind in their name."""
    if kind not in PRIOR_KINDS:
        raise CheckFailed(f"unknown prior-education kind {kind}")
    brin, loc = "InstellingVanDe" + kind, "VestigingsnummerVanDe" + kind
    renamed = register.withColumnsRenamed({
        "Brinnummer": brin,
        "Vestigingsnummer": loc,
        "NaamInstellingVooropleiding": "NaamInstelling" + kind,
        "PostcodeInstellingVooropleiding": "PostcodeInstelling" + kind,
        "PlaatsInstellingVooropleiding": "PlaatsInstelling" + kind,
        "DatumOprichtingInstellingVooropleiding": "DatumOprichtingInstelling" + kind,
        "DatumOpheffingInstellingVooropleiding": "DatumOpheffingInstelling" + kind,
        "DenominatieInstellingVooropleidingCode": "CodeDenominatieInstelling" + kind,
        "NaamDenominatieInstellingVooropleiding": "DenominatieInstelling" + kind,
    })
    return lookup_join(enr, renamed, [brin, loc], suffix="_Vooropleiding", name="institution register")


def add_programme_name(enr: DataFrame, dec_isat: DataFrame, on_missing: str = "fail") -> DataFrame:
    """E5: ``NaamOpleidingCroho`` by current programme code.

    The code list must be unique (J2, checked inside the join).  A programme without a name fails
    (``on_missing='fail'``) or is named ``onbekend`` (ledger L20).
    """
    isat = dec_isat.select("Opleidingscode", F.col("NaamOpleiding").alias("NaamOpleidingCroho"))
    j = lookup_join(enr, isat, [("OpleidingActueelEquivalent", "Opleidingscode")], suffix="_opleiding",
                    unique_right=True, name="Dec_isat")
    if on_missing == "fail":
        return require_not_null(j, "NaamOpleidingCroho", "programme names")
    return j.fillna(UNKNOWN, subset=["NaamOpleidingCroho"])


def add_programme(enr: DataFrame) -> DataFrame:
    """``opleiding`` = historical code when present, else current code."""
    return enr.withColumn("opleiding", F.coalesce("OpleidingHistorischEquivalent", "OpleidingActueelEquivalent"))


def add_sector(enr: DataFrame) -> DataFrame:
    """Sector name from the sector code (string keys, ledger L2)."""
    require_columns(enr, ["CrohoOnderdeelActueleOpleiding"], "sector")
    return enr.withColumn("CrohoOnderdeel", sector_of("CrohoOnderdeelActueleOpleiding"))


def add_diploma_kind(enr: DataFrame) -> DataFrame:
    """E8."""
    require_columns(enr, ["OpleidingsfaseActueelVanHetDiploma"], "diploma kind")
    return enr.withColumn("SoortDiploma", diploma_kind_of("OpleidingsfaseActueelVanHetDiploma"))


def first_year_degree(enr: DataFrame) -> DataFrame:
    """A higher-education degree (kind 3..10) in the first year at the institution."""
    kind = F.col("SoortDiplomaSoortHogerOnderwijs")
    return enr.withColumn(
        "HoDiplomaInEersteJaar",
        flag(kind.between(3, 10) & (F.col("Diplomajaar") == F.col("EersteJaarAanDezeActueleInstelling"))),
    )


def add_programme_type(enr: DataFrame) -> DataFrame:
    """E10."""
    return enr.withColumn("TypeOpleiding", programme_type_of("Opleidingsfase"))


def add_local_names(enr: DataFrame, local_names: DataFrame, unmatched: Observation | None = None) -> DataFrame:
    """Local programme and faculty names by current code.

    ``unmatched`` notes, during the job that computes the result, which codes
    found no name (``observed_unmatched``)."""
    if unmatched is not None:
        local_names = local_names.withColumn(MATCHED, F.lit(True))
    out = lookup_join(enr, local_names, [("OpleidingActueelEquivalent", "Opleidingscode")], suffix="_naam",
                      name="local programme names")
    if unmatched is None:
        return out
    code = F.col("OpleidingActueelEquivalent").try_cast("bigint")
    missed, fits = F.col(MATCHED).isNull(), truthy(code.between(1, BITS * BITMAPS))
    metrics = [F.count_if(missed).alias("rows"), F.count_if(missed & ~fits).alias("beyond")]
    metrics += [F.bitmap_construct_agg(F.when(missed & fits & (F.bitmap_bucket_number(code) == k + 1), F.bitmap_bit_position(code))).alias(f"codes_{k}")
                for k in range(BITMAPS)]
    return out.observe(unmatched, *metrics).drop(MATCHED)


def observed_unmatched(unmatched: Observation) -> list[int] | None:
    """The codes without a local name that a finished job noted; None if one
    of them is no number of five digits and the notes have no place for it."""
    got = unmatched.get
    if got["beyond"]:
        return None
    return [k * BITS + 8 * byte + bit + 1 for k in range(BITMAPS) for byte, held in enumerate(got[f"codes_{k}"]) if held
            for bit in range(8) if held >> bit & 1]


def programmes_without_local_name(enr: DataFrame, local_names: DataFrame, codes: list[int] | None = None) -> DataFrame:
    """E11 report: distinct programmes that have no local name.  ``codes``
    are theirs, if known; else they are found by an anti-join."""
    found = (anti_join(enr, local_names, [("OpleidingActueelEquivalent", "Opleidingscode")]) if codes is None
             else enr.filter(F.col("OpleidingActueelEquivalent").try_cast("bigint").isin(codes)))
    return found.select("OpleidingActueelEquivalent", "NaamOpleidingCroho").distinct()


def pa_cohort_predicates(enr: DataFrame):
    """E12's seven conditions, each null-safe."""
    code = zero_pad(F.col("Opleidingscode").cast("string"), 5)  # leading zero restored (L21)
    return {
        "active": truthy(F.col("IndicatieActiefOpPeildatum") == 1),
        "main": truthy(as_int("SoortInschrijvingHogerOnderwijs") == 1),
        "bachelor": eq("TypeHogerOnderwijsBinnenSoortHogerOnderwijs", F.lit("ba")),
        "not_associate": F.coalesce(~code.startswith("80"), F.lit(True)),
        "full_time": eq("Opleidingsvorm", F.lit("voltijd")),
        "direct_intake": eq("HoogsteVooropleiding", "HoogsteVooropleidingVoorHetHo"),
        "first_year_he": eq("EersteJaarInHetHogerOnderwijs", "Inschrijvingsjaar"),
    }


def add_pa_cohort(enr: DataFrame) -> DataFrame:
    """``InPACohortDefinitie`` Ja/Nee (conjunction of seven predicates)."""
    preds = list(pa_cohort_predicates(enr).values())
    cond = preds[0]
    for p in preds[1:]:
        cond = cond & p
    return enr.withColumns({"Aantal": F.lit(1), "InPACohortDefinitie": label(cond, "Ja", "Nee")})


def add_isced(enr: DataFrame, dec_ho_isced: DataFrame) -> DataFrame:
    """ISCED classification by programme code: unique lookup, row count
    kept, and every row classified — checked on the joined column (L19)."""
    j = lookup_join(enr, dec_ho_isced, ["Opleidingscode"], suffix="_opleiding", unique_right=True,
                    name="Dec_ho_ISCED")
    if not added_columns(enr, j):
        raise CheckFailed("ISCED join added no columns")
    return require_not_null(j, joined_name(enr, "ISCEDF2013Rubriek", "_opleiding"), "ISCED")


def enrich_enrolments(enr: DataFrame, lookups: Lookups, *, prior_field: str = "HoogsteVooropleiding",
                      on_missing_name: str = "fail", unmatched: Observation | None = None) -> DataFrame:
    """The enrichment chain, in the register's order; ``unmatched`` notes the codes without a local name."""
    out = enr.withColumn("Aantal", F.lit(1))
    out = add_prior_education(out, lookups.dec_vopl, prior_field)
    out = add_prior_institution(out, lookups.dec_brinvestigingsnummer, prior_field)
    out = add_programme_name(out, lookups.dec_isat, on_missing_name)
    out = add_programme(out)
    out = add_sector(out)
    out = add_diploma_kind(out)
    out = first_year_degree(out)
    out = add_programme_type(out)
    if lookups.local_names is not None:
        out = add_local_names(out, lookups.local_names, unmatched)
    out = add_pa_cohort(out)
    out = add_isced(out, lookups.dec_ho_isced)
    log.info("enrichment added columns: %s", added_columns(enr, out))
    return out
