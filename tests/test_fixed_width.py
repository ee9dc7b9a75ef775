"""Fixed-width scan: records, garbage, layouts, folders (FIXTURES A2, A3; S1–S7)."""

import os

import pytest
from pyspark.sql import Observation

from fixreg.sources.fixed_width import garbage_rows, parse_fixed_width, read_directory, read_fixed_width
from fixreg.sources.layout import ColumnSpec, Layout, get_layout, layouts_in, resolve_layout
from fixreg.streaming import convert_stream

from registerfiles import render, write_latin1

LAY = Layout("Dec_test", (
    ColumnSpec("code", 1, 4, "string"),
    ColumnSpec("naam", 5, 10, "string"),
    ColumnSpec("jaar", 15, 4, "bigint"),
))


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "__line string")


def test_latin1_file(spark, workdir):
    p = write_latin1(os.path.join(workdir, "Dec_test.asc"), ["0001Café      2024"])
    row = read_fixed_width(spark, p, LAY).collect()[0]
    assert row["naam"] == "Café" and row["jaar"] == 2024


def test_blank_and_short_lines(spark):
    out = parse_fixed_width(lines_df(spark, ["", "    ", "0002Kort"]), LAY).collect()
    assert len(out) == 1 and out[0]["naam"] == "Kort" and out[0]["jaar"] is None


def test_garbage_policies(spark):
    good = "0001Naam      2024"
    bad = good + "   XX"
    far = good + " " * 10 + "ZZ"
    df = lines_df(spark, [good, bad, far])
    kept = parse_fixed_width(df, LAY, on_garbage="keep").orderBy("code").collect()
    assert [r["GarbageColumn"] for r in kept].count("XX") == 1
    assert [r["GarbageColumn"] for r in kept].count("ZZ") == 1  # behind ten blanks
    assert parse_fixed_width(df, LAY, on_garbage="quarantine").count() == 1
    assert garbage_rows(df, LAY).count() == 2  # whole rest of the line
    assert garbage_rows(df, LAY, garbage_width=10).count() == 1
    with pytest.raises(Exception, match="data found after position 18"):
        parse_fixed_width(df, LAY, on_garbage="fail").collect()


def test_bad_values_counted_or_strict(spark):
    df = lines_df(spark, ["0001Naam      20x4", "0002Naam      2024"])
    obs = Observation("scan")
    out = parse_fixed_width(df, LAY, observation=obs).collect()
    assert [r["jaar"] for r in out] == [None, 2024]
    assert obs.get["bad_jaar"] == 1 and obs.get["rows"] == 2
    with pytest.raises(Exception, match="jaar"):
        parse_fixed_width(df, LAY, strict=True).collect()


def test_untyped(spark):
    row = parse_fixed_width(lines_df(spark, ["0001Naam      0024"]), LAY, typed=False).collect()[0]
    assert row["jaar"] == "0024"


def test_declared_vs_cumulative_offsets():
    land = get_layout("Dec_landcode")
    issues = land.issues()
    assert any("EtniciteitLangCode: declared start 48, cumulative 58" in i for i in issues)
    assert land.starts("cumulative")[4] == 58 and land.starts("declared")[4] == 48
    assert land.record_width == 91


def test_bundled_layouts():
    all_ = layouts_in()
    assert len(all_) == 20
    assert len(all_["EV____24"].columns) == 115 and all_["EV____24"].record_width == 323
    assert all_["VAKHAVW_____"].record_width == 82
    assert sum(len(x.columns) for x in all_.values()) == 235


def test_reference_header_style_and_unknown_converter():
    text = "Label,StartingPosition,NumberOfPositions,Converter\nA,1,2,convert_to_int64\nB,3,1,convert_to_x\n"
    lay = Layout.parse_csv("X", text)
    assert lay.unknown_converters() == ["B"]
    assert lay.schema().fields[0].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("stem,expected", [
    ("dec_ISAT", "Dec_isat"), ("EV21XX24", "EV____24"), ("VAKHAVW_21XX", "VAKHAVW_____"), ("notes", None),
])
def test_resolve_layout(stem, expected):
    assert resolve_layout(stem, list(layouts_in())) == expected


def test_read_directory(spark, workdir):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    isat = get_layout("Dec_isat")
    write_latin1(os.path.join(src, "dec_ISAT.asc"), render(isat, [{"Opleidingscode": "34560", "NaamOpleiding": "B X"}]))
    open(os.path.join(src, "Dec_vopl.asc"), "w").close()  # empty
    write_latin1(os.path.join(src, "notes.txt"), ["hello"])
    scan = read_directory(spark, src)
    assert set(scan.tables) == {"Dec_isat"}
    assert scan.status["Dec_vopl.asc"] == "empty" and scan.status["notes.txt"] == "no layout"
    row = scan.tables["Dec_isat"].collect()[0]
    assert row["NaamOpleiding"] == "B X" and row["source_file"].endswith("dec_ISAT.asc")


def test_stream_conversion(spark, workdir):
    src = os.path.join(workdir, "landing")
    os.makedirs(src)
    write_latin1(os.path.join(src, "a.asc"), ["0001Naam      2024", "0002Twee      2025"])
    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    convert_stream(spark, src, LAY, out, ck).awaitTermination()
    assert sorted(r["jaar"] for r in spark.read.parquet(out).collect()) == [2024, 2025]


def test_gzip_input_is_spread(spark, workdir):
    import gzip

    path = os.path.join(workdir, "Dec_test.asc.gz")
    line = "0001Naam      2024\n"
    with gzip.open(path, "wb") as f:
        f.write((line * 400000).encode("latin-1"))  # > 4 MB of text, one unsplittable file
    df = read_fixed_width(spark, path, LAY, spread_lines=True)
    assert df.rdd.getNumPartitions() >= 2 and df.count() == 400000
