"""Enrichment rules (E1, E2, E7–E12) and an end-to-end run from fixed-width files."""

import os

import pytest
from pyspark.sql import functions as F

from fixreg.functions.codes import classify_prior_education, profile_of
from fixreg.plans import cohort as K
from fixreg.plans import enrich as E
from fixreg.sources.fixed_width import read_fixed_width
from fixreg.sources.layout import get_layout

from registerfiles import render, write_latin1


@pytest.mark.parametrize("text,label", [
    ("MBO niveau 4", "mbo"), ("vwo", "vwo"), ("HAVO/VWO", "vwo"), ("havo", "havo"), ("hbo-p", "hbo-p"),
    ("hbo-ba", "hbo-ba"), ("hbo-ad", "hbo-ad"), ("hbo-vo/ma", "hbo-master"), ("hbo-pim", "hbo-master"),
    ("wo-p", "wo-p"), ("wo-ba", "wo-ba"), ("wo-on/ma", "wo-master"), ("wo-pim", "wo-master"),
    ("wo-vo/ma/bf", "wo-master"), ("mbov", "overig"), (None, "overig"),
])
def test_classify(spark, text, label):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(classify_prior_education("t")).collect()[0][0] == label


def test_profile(spark):
    df = spark.createDataFrame([("00400",), ("00211",), ("00300",)], "c string")
    assert [r[0] for r in df.select(profile_of("c")).collect()] == ["ONG", "NT & NG", None]


BASE = dict(IndicatieActiefOpPeildatum=1, SoortInschrijvingHogerOnderwijs="1",
            TypeHogerOnderwijsBinnenSoortHogerOnderwijs="ba", Opleidingscode=34560, Opleidingsvorm="voltijd",
            HoogsteVooropleiding="00401", HoogsteVooropleidingVoorHetHo="00401", EersteJaarInHetHogerOnderwijs=2020,
            Inschrijvingsjaar=2020)
SCHEMA = ("IndicatieActiefOpPeildatum bigint, SoortInschrijvingHogerOnderwijs string, "
          "TypeHogerOnderwijsBinnenSoortHogerOnderwijs string, Opleidingscode bigint, Opleidingsvorm string, "
          "HoogsteVooropleiding string, HoogsteVooropleidingVoorHetHo string, EersteJaarInHetHogerOnderwijs bigint, "
          "Inschrijvingsjaar bigint")
FAIL_ONE = [
    dict(), dict(IndicatieActiefOpPeildatum=0), dict(SoortInschrijvingHogerOnderwijs="2"),
    dict(TypeHogerOnderwijsBinnenSoortHogerOnderwijs="ma"), dict(Opleidingscode=80012),
    dict(Opleidingsvorm="deeltijd"), dict(HoogsteVooropleidingVoorHetHo="00301"),
    dict(EersteJaarInHetHogerOnderwijs=2019), dict(Opleidingscode=8012),
]


def test_pa_cohort_predicates(spark):
    names = SCHEMA.split(", ")
    rows = [tuple({**BASE, **o}[n.split(" ")[0]] for n in names) for o in FAIL_ONE]
    out = [r["InPACohortDefinitie"] for r in E.add_pa_cohort(spark.createDataFrame(rows, SCHEMA)).collect()]
    # first row passes all; each of the seven fails alone; 08012 does not start with 80
    assert out == ["Ja"] + ["Nee"] * 7 + ["Ja"]


def test_recodes(spark):
    df = spark.createDataFrame([("3", "B", "D"), ("X", None, "Z"), (None, "P", None)],
                               "CrohoOnderdeelActueleOpleiding string, Opleidingsfase string, "
                               "OpleidingsfaseActueelVanHetDiploma string")
    out = E.add_diploma_kind(E.add_programme_type(E.add_sector(df))).collect()
    assert [(r["CrohoOnderdeel"], r["TypeOpleiding"], r["SoortDiploma"]) for r in out] == [
        ("natuur", "bachelor", "propedeuse"), ("X", "onbekend", "Z"), ("onbekend", "propedeuse", None)]


def _lookups(spark):
    vopl = spark.createDataFrame([("00401", "vwo profiel ALG")], "VooropleidingCode string, OmschrijvingVooropleiding string")
    brin = spark.createDataFrame([("99AA", "00", "Het Lyceum", "1234", "Ergens", None, None, "1", "Openbaar")],
                                 "Brinnummer string, Vestigingsnummer string, NaamInstellingVooropleiding string, "
                                 "PostcodeInstellingVooropleiding string, PlaatsInstellingVooropleiding string, "
                                 "DatumOprichtingInstellingVooropleiding date, DatumOpheffingInstellingVooropleiding date, "
                                 "DenominatieInstellingVooropleidingCode string, NaamDenominatieInstellingVooropleiding string")
    isat = spark.createDataFrame([("34560", "B Testopleiding")], "Opleidingscode string, NaamOpleiding string")
    isced = spark.createDataFrame([(34560, "0913", "Verpleging", "091300", "Gezondheid")],
                                  "Opleidingscode bigint, ISCEDF2013Detailgroep string, "
                                  "ISCEDF2013DetailgroepOmschrijving string, ISCEDF2013Rubriek string, "
                                  "ISCEDF2013RubriekOmschrijving string")
    local = spark.createDataFrame([("34560", "BTO", "Testopleiding", "Faculteit Zorg", "FZ")],
                                  "Opleidingscode string, CodeOpleiding string, NaamOpleiding string, "
                                  "NaamFaculteit string, CodeFaculteit string")
    return E.Lookups(vopl, brin, isat, isced, local)


A5 = dict(PersoonsgebondenNummer="000000000017", Inschrijvingsjaar="2020", EersteJaarAanDezeActueleInstelling="2020",
          EersteJaarInHetHogerOnderwijs="2020", IndicatieActiefOpPeildatum="1", SoortInschrijvingHogerOnderwijs="1",
          ActueleInstelling="21XX", Opleidingscode="34560", OpleidingActueelEquivalent="34560", Opleidingsvorm="1",
          Opleidingsfase="B", TypeHogerOnderwijsBinnenSoortHogerOnderwijs="ba", CrohoOnderdeelActueleOpleiding="5",
          HoogsteVooropleiding="00401", HoogsteVooropleidingVoorHetHo="00401",
          InstellingVanDeHoogsteVooropleiding="99AA", VestigingsnummerVanDeHoogsteVooropleiding="00",
          ISCEDF2013Rubriek="0913", Geslacht="V", Burgerservicenummer="123456789")


def test_end_to_end_from_register_files(spark, workdir):
    ev = get_layout("EV____24")
    rows = [
        A5,
        {**A5, "Inschrijvingsjaar": "2021", "Diplomajaar": "2024", "OpleidingsfaseActueelVanHetDiploma": "B",
         "SoortDiplomaSoortHogerOnderwijs": "3", "DatumTekeningDiploma": "20240701"},
        {**A5, "PersoonsgebondenNummer": "000000000018", "Geslacht": "M", "Opleidingsvorm": "2"},
    ]
    path = write_latin1(os.path.join(workdir, "EV21XX24.asc"), render(ev, rows))
    enr = read_fixed_width(spark, path, ev)
    assert len(enr.columns) == 115 and enr.count() == 3
    first = enr.filter(F.col("Inschrijvingsjaar") == 2020).orderBy("PersoonsgebondenNummer").collect()
    assert first[0]["Geslacht"] == "vrouw" and first[0]["Opleidingsvorm"] == "voltijd"
    assert first[1]["Opleidingsvorm"] == "deeltijd" and first[0]["Diplomajaar"] is None
    enriched = E.enrich_enrolments(enr, _lookups(spark))
    e = enriched.filter(F.col("Inschrijvingsjaar") == 2020).orderBy("PersoonsgebondenNummer").collect()
    assert e[0]["NaamOpleidingCroho"] == "B Testopleiding" and e[0]["HoogsteVooropleidingProfiel"] == "ALG"
    assert e[0]["NaamInstellingHoogsteVooropleiding"] == "Het Lyceum" and e[0]["CrohoOnderdeel"] == "gezondheidszorg"
    assert e[0]["InPACohortDefinitie"] == "Ja" and e[1]["InPACohortDefinitie"] == "Nee"  # part-time
    assert e[0]["ISCEDF2013Rubriek_opleiding"] == "091300"
    coh = {r["PersoonsgebondenNummer"]: r for r in K.build_cohort(enriched).collect()}
    assert coh["000000000017"]["UitvalEerstejaar"] == 0 and coh["000000000018"]["UitvalEerstejaar"] == 1
    assert coh["000000000017"]["JaarTotEenDiploma"] == 4 and coh["000000000017"]["EenDiplomaBinnen5jaar"] == 1


def test_missing_programme_name(spark):
    lk = _lookups(spark)
    df = spark.createDataFrame([("99999",)], "OpleidingActueelEquivalent string")
    with pytest.raises(Exception, match="NaamOpleidingCroho"):
        E.add_programme_name(df, lk.dec_isat).collect()
    assert E.add_programme_name(df, lk.dec_isat, on_missing="unknown").collect()[0]["NaamOpleidingCroho"] == "onbekend"


def test_code_list_must_be_unique_even_unmatched(spark):
    df = spark.createDataFrame([("34560",)], "OpleidingActueelEquivalent string")
    dup = spark.createDataFrame([("34560", "A"), ("99999", "B"), ("99999", "C")], "Opleidingscode string, NaamOpleiding string")
    with pytest.raises(Exception, match="not unique or has nulls"):
        E.add_programme_name(df, dup).collect()
    nul = spark.createDataFrame([("34560", "A"), (None, "B")], "Opleidingscode string, NaamOpleiding string")
    with pytest.raises(Exception, match="not unique or has nulls"):
        E.add_programme_name(df, nul).collect()
