"""Both workflows end to end: register extracts → converted tables → assets."""

import os

from fixreg.plans.assets import convert_register, create_assets, publish_assets
from fixreg.sources.layout import get_layout

from registerfiles import render, write_latin1
from test_enrich import A5


def _write(src, name, layout, rows):
    write_latin1(os.path.join(src, name), render(get_layout(layout), rows))


def test_convert_then_assets(spark, workdir):
    src, conv, assets = (os.path.join(workdir, x) for x in ("in", "conv", "assets"))
    os.makedirs(src)
    _write(src, "EV21XX24.asc", "EV____24", [
        A5,
        {**A5, "Inschrijvingsjaar": "2021", "Diplomajaar": "2023", "OpleidingsfaseActueelVanHetDiploma": "B",
         "DatumTekeningDiploma": "20230701", "SoortDiplomaSoortHogerOnderwijs": "3"},
        {**A5, "PersoonsgebondenNummer": "000000000018", "Burgerservicenummer": "987654321"},
    ])
    _write(src, "VAKHAVW_21XX.asc", "VAKHAVW_____", [
        {"PersoonsgebondenNummer": "000000000017", "VooropleidingOorspronkelijkeCode": "00401",
         "Diplomajaar": "2019", "VakCode": "0001", "VakAfkorting": "ne", "CijferSchoolexamen": "070",
         "CijferEersteCentraalExamen": "055", "CijferTweedeCentraalExamen": "068", "Burgerservicenummer": "123456789"},
    ])
    _write(src, "Dec_vopl.asc", "Dec_vopl", [{"VooropleidingCode": "00401", "OmschrijvingVooropleiding": "vwo profiel ALG"}])
    _write(src, "Dec_brinvestigingsnummer.asc", "Dec_brinvestigingsnummer", [
        {"Brinnummer": "99AA", "Vestigingsnummer": "00", "NaamInstellingVooropleiding": "Het Lyceum",
         "DatumOprichtingInstellingVooropleiding": "19900101"}])
    _write(src, "Dec_isat.asc", "Dec_isat", [{"Opleidingscode": "34560", "NaamOpleiding": "B Testopleiding"}])
    _write(src, "Dec_ho_ISCED.asc", "Dec_ho_ISCED", [
        {"Opleidingscode": "34560", "ISCEDF2013Detailgroep": "0913", "ISCEDF2013Rubriek": "091300"}])
    _write(src, "Dec_vooropl.asc", "Dec_vooropl", [
        {"VooropleidingOorspronkelijkeCode": "00401", "Onderwijssector": "VWO",
         "OmschrijvingVooropleidingOorspronkelijkeCode": "vwo profiel ALG"}])
    write_latin1(os.path.join(src, "leesmij.txt"), ["no layout for this file"])

    status = convert_register(spark, src, conv, salt="geheim", mode="permute")
    assert status["EV____24"] == "written" and status["leesmij.txt"] == "no layout"
    ev = spark.read.parquet(os.path.join(conv, "EV____24"))
    assert all(r["Burgerservicenummer"] is None for r in ev.collect())
    assert {r["PersoonsgebondenNummer"] for r in ev.collect()} == {"000000000017", "000000000018"}  # a permutation

    written = create_assets(spark, conv, assets)
    assert set(written) == {"enrolment_enriched", "cohort", "exam_grade"}
    cohort = spark.read.parquet(written["cohort"]).collect()
    grades = spark.read.parquet(written["exam_grade"]).collect()
    stayer = [r for r in cohort if r["UitvalEerstejaar"] == 0]
    assert len(cohort) == 2 and len(stayer) == 1
    assert stayer[0]["JaarTotEenDiploma"] == 3 and stayer[0]["NaamOpleidingCroho"] == "B Testopleiding"
    # one consistent pseudo id across the enrolment and exam tables
    assert {r["PersoonsgebondenNummer"] for r in grades} == {stayer[0]["PersoonsgebondenNummer"]}
    assert sorted((r["SoortExamen"], r["Poging"], r["Cijfer"]) for r in grades) == [("CSE", 2, 68), ("School", 1, 70)]

    views = publish_assets(spark, conv, "fixreg_assets_test", location=os.path.join(workdir, "catalog"))
    assert "fixreg_assets_test.enrolment" in views
    assert spark.table("fixreg_assets_test.exam_subject").count() == 1


def test_convert_to_csv_without_pii_removal(spark, workdir):
    src, out = os.path.join(workdir, "in"), os.path.join(workdir, "csv")
    os.makedirs(src)
    _write(src, "Dec_isat.asc", "Dec_isat", [{"Opleidingscode": "04586", "NaamOpleiding": "B Nul vooraan"}])
    status = convert_register(spark, src, out, fmt="csv", remove_pii=False)
    assert status == {"Dec_isat": "written"}
    back = spark.read.option("header", True).csv(os.path.join(out, "Dec_isat")).collect()
    assert back[0]["Opleidingscode"] == "04586" and back[0]["NaamOpleiding"] == "B Nul vooraan"


def test_all_years_are_read(spark, workdir):
    from fixreg.plans.assets import converted_tables

    spark.createDataFrame([(1,)], "a int").write.parquet(f"{workdir}/VAKHAVW_2023")
    spark.createDataFrame([(2, "x")], "a int, b string").write.parquet(f"{workdir}/VAKHAVW_2024")
    assert sorted(map(tuple, converted_tables(spark, workdir, "VAKHAVW").collect())) == [(1, None), (2, "x")]
    assert converted_tables(spark, workdir, "EV") is None
