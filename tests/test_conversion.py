"""The conversion's accounts, second output, local ids and clean-up; layouts by year; common types; profiles."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.functions.lattice import common_type, union_deliveries
from fixreg.operators import merge_profiles, profile_columns, profile_estimates, pseudonymise
from fixreg.operators.profile import DISTINCT_ERROR, RANK_ERROR
from fixreg.plans.assets import convert_register
from fixreg.session import ScratchSpace, ensure_checkpoint_dir
from fixreg.sinks import ExportFailed
from fixreg.sources import ColumnSpec, Edition, Layout, LayoutEditions, layouts_in, read_editions

from registerfiles import render, write_latin1

PGN = "PersoonsgebondenNummer"
PEOPLE = Layout("EV____24", (ColumnSpec(PGN, 1, 12), ColumnSpec("jaar", 13, 4, "bigint"), ColumnSpec("Burgerservicenummer", 17, 9)))
EXAMS = Layout("VAKHAVW_____", (ColumnSpec(PGN, 1, 12), ColumnSpec("cijfer", 13, 3, "bigint")))
LAYOUTS = {"EV____24": PEOPLE, "VAKHAVW_____": EXAMS}


@pytest.fixture()
def extract(workdir):
    src = os.path.join(workdir, "in")
    os.makedirs(src)
    people = render(PEOPLE, [{PGN: f"{i:012d}", "jaar": "X003" if i in (2, 5) else "2020", "Burgerservicenummer": "123456789"} for i in range(9)])
    people[3] += "EXTRA"
    write_latin1(os.path.join(src, "EV21XX24.asc"), people)
    write_latin1(os.path.join(src, "VAKHAVW_21XX.asc"), render(EXAMS, [{PGN: f"{i:012d}", "cijfer": "070"} for i in range(4)] + [{PGN: "000000000001", "cijfer": "a"}]))
    return src


def scratch_of(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {n for n in os.listdir(base) if n.startswith("fixreg-") and "session" not in n}


@pytest.mark.parametrize("mode", ["hash", "permute"])
def test_quarantine_and_accounts(spark, workdir, extract, mode):
    before = scratch_of(spark)
    out, apart = os.path.join(workdir, "out"), os.path.join(workdir, "apart")
    status = convert_register(spark, extract, out, layouts=LAYOUTS, salt="s", mode=mode, on_garbage="quarantine", quarantine_dir=apart)
    assert status == {"EV____24": "written; unreadable cells: jaar 2; quarantined records: 1", "VAKHAVW_____": "written; unreadable cells: cijfer 1"}
    account = status.accounts["EV____24"]
    assert (account.records, account.garbage, account.quarantined, dict(account.bad_cells)) == (9, 1, 1, {"jaar": 2})
    good, bad = spark.read.parquet(f"{out}/EV____24"), spark.read.parquet(f"{apart}/EV____24")
    assert good.count() == 8 and [r["GarbageColumn"] for r in bad.collect()] == ["EXTRA"] and bad.first()["record"].startswith("000000000003")
    assert good.columns == ["source_file", PGN, "jaar", "Burgerservicenummer"] and os.listdir(apart) == ["EV____24"]
    assert good.where("jaar IS NULL").count() == 2 and good.where("Burgerservicenummer IS NOT NULL").count() == 0
    assert scratch_of(spark) == before


def test_quarantine_needs_a_folder(spark, workdir, extract):
    with pytest.raises(ValueError, match="quarantine_dir"):
        convert_register(spark, extract, workdir, layouts=LAYOUTS, salt="s", on_garbage="quarantine")


def test_strict_and_missing_markers_reach_the_conversion(spark, workdir, extract):
    with pytest.raises(ExportFailed, match="jaar has a value") as err:
        convert_register(spark, extract, f"{workdir}/a", layouts=LAYOUTS, salt="s", on_garbage="keep", strict=True)
    assert set(err.value.status) == {"EV____24", "VAKHAVW_____"} and not os.path.exists(f"{workdir}/a/EV____24")
    status = convert_register(spark, extract, f"{workdir}/b", layouts=LAYOUTS, salt="s", on_garbage="keep", na_values=("X003", "a"))
    assert status == {"EV____24": "written", "VAKHAVW_____": "written"} and status.accounts["EV____24"].garbage == 1


def test_failed_table_leaves_no_ids_and_no_half_permutation(spark, workdir, extract):
    before = scratch_of(spark)
    with pytest.raises(ExportFailed, match="data found after position") as err:
        convert_register(spark, extract, f"{workdir}/out", layouts=LAYOUTS, salt="s", mode="permute")
    assert "crosswalk" in err.value.status["VAKHAVW_____"]
    assert scratch_of(spark) == before and not os.path.exists(f"{workdir}/out")
    ids = spark.createDataFrame([("1",), ("0000001",)], f"{PGN} string")
    with pytest.raises(Exception, match="zero-padding"), ScratchSpace(spark, "pair") as scratch:
        pseudonymise({"t": ids}, salt="s", mode="permute", scratch=scratch)
    assert scratch_of(spark) == before


def test_overlapping_pseudonymisations_are_both_readable(spark, workdir, extract):
    ids = spark.createDataFrame([(f"{i:012d}", i) for i in range(40)], f"{PGN} string, i int")
    with ScratchSpace(spark, "a") as a:
        first = pseudonymise({"t": ids}, salt="one", mode="permute", scratch=a)["t"]
        with ScratchSpace(spark, "b") as b:
            second = pseudonymise({"t": ids}, salt="two", mode="permute", scratch=b)["t"]
            convert_register(spark, extract, f"{workdir}/out", layouts=LAYOUTS, salt="three", mode="permute", on_garbage="keep")
            assert second.select(PGN).distinct().count() == 40
        one = {r["i"]: r[PGN] for r in first.collect()}
    assert sorted(one.values()) == [f"{i:012d}" for i in range(40)] and one != {i: f"{i:012d}" for i in range(40)}


def test_local_ids_without_pseudonyms(spark, workdir, extract):
    local = spark.createDataFrame([("000000000001", "S1"), ("000000000002", "S2")], "pgn string, studentnummer string")
    convert_register(spark, extract, f"{workdir}/out", layouts=LAYOUTS, remove_pii=False, on_garbage="keep", local_ids=local, local_id_keys=(PGN, "pgn"))
    ev = spark.read.parquet(f"{workdir}/out/EV____24")
    assert "pgn" not in ev.columns and {r[PGN]: r["studentnummer"] for r in ev.where("studentnummer IS NOT NULL").collect()} == {"000000000001": "S1", "000000000002": "S2"}
    twice = local.unionByName(local)
    with pytest.raises(ExportFailed, match="more than one row"):
        convert_register(spark, extract, f"{workdir}/out2", layouts=LAYOUTS, remove_pii=False, on_garbage="keep", local_ids=twice, local_id_keys=(PGN, "pgn"))


def test_editions_resolve_as_of_the_year():
    ed = LayoutEditions.of(layouts_in())
    assert ed.intervals("Dec_postcodecijfers") == [(2023, 2023, "Dec_postcodecijfers_2023"), (2024, None, "Dec_postcodecijfers_2024")]
    assert ed.family_of("dec_POSTCODECIJFERS_2025") == "Dec_postcodecijfers" and ed.family_of("EV21XX24") == "EV"
    assert [ed.valid("Dec_postcodecijfers", y) and ed.valid("Dec_postcodecijfers", y).name[-4:] for y in (2022, 2023, 2030, None)] == [None, "2023", "2024", "2024"]
    assert ed.valid("Dec_isat", 1999).name == "Dec_isat" and ed.family_of("notes") is None
    with pytest.raises(ValueError, match="same year"):
        LayoutEditions({"x": [Edition(PEOPLE, 2020), Edition(EXAMS, 2020)]})


def test_files_of_two_years_in_one_scan(spark, workdir):
    old = Layout("Dec_x_2023", (ColumnSpec("a", 1, 3, "bigint"), ColumnSpec("b", 4, 2)))
    new = Layout("Dec_x_2024", (ColumnSpec("b", 1, 2), ColumnSpec("a", 3, 4), ColumnSpec("c", 7, 2, "bigint")))
    write_latin1(f"{workdir}/Dec_x_2022.asc", ["001aa"])
    write_latin1(f"{workdir}/dec_X_2023.asc", ["007aa", "X08bé"])
    write_latin1(f"{workdir}/Dec_x_2025.asc", ["ccK  9 5", "dd    zz"])
    scan = read_editions(spark, workdir, LayoutEditions.of({"Dec_x_2023": old, "Dec_x_2024": new}), observe=True, on_garbage="keep")
    df = scan.tables["Dec_x"]
    got = {(r["a"], r["b"], r["c"]) for r in df.collect()}
    assert got == {("7", "aa", None), (None, "bé", None), ("K  9", "cc", 5), (None, "dd", None)}
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert {k: v for k, v in scan.observations["Dec_x"].get.items() if v} == {"rows": 4, "bad_a": 1, "bad_c": 1}
    assert scan.status["Dec_x_2022.asc"] == "no layout of Dec_x was valid in 2022"
    assert dict(df.dtypes)["a"] == "string"


def test_conversion_by_editions(spark, workdir):
    os.mkdir(f"{workdir}/in")
    for year in (2023, 2024):
        write_latin1(f"{workdir}/in/Dec_postcodecijfers_{year}.asc", [f"{year}N0000Plaats"])
    status = convert_register(spark, f"{workdir}/in", f"{workdir}/out", layouts=LayoutEditions.of(layouts_in()))
    assert status == {"Dec_postcodecijfers": "written"}
    assert {r["Postcodecijfers"] for r in spark.read.parquet(f"{workdir}/out/Dec_postcodecijfers").collect()} == {"2023", "2024"}


def test_common_types():
    big, small, text, day, real = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.DoubleType()
    assert common_type(big, small) == big and common_type(small, real) == real and common_type(big, text) == text
    assert common_type(day, T.TimestampType()) == T.TimestampType() and common_type(day, big) == text and common_type(T.NullType(), day) == day
    assert common_type(T.FloatType(), small) == real
    kinds = [big, small, text, day, real, T.NullType(), T.BooleanType(), T.TimestampType(), T.FloatType(), T.DecimalType(9, 2)]
    for a in kinds:
        for b in kinds:
            assert common_type(a, b) == common_type(b, a)
            for c in kinds:
                assert common_type(common_type(a, b), c) == common_type(a, common_type(b, c))
    with pytest.raises(ValueError, match="no common type"):
        common_type(T.ArrayType(big), text)


def test_union_reports_conflicts_and_loses_nothing(spark):
    a = spark.createDataFrame([(1, None, True), (2, 5, None)], "k int, x bigint, only_a boolean")
    b = spark.createDataFrame([(3, "05"), (4, None)], "k bigint, x string")
    out, conflicts = union_deliveries({"2024": a, "2025": b})
    assert sorted(map(tuple, out.collect())) == [(1, None, True), (2, "5", None), (3, "05", None), (4, None, None)]
    assert [(c.column, c.chosen, dict(c.types)) for c in conflicts] == [("k", "bigint", {"2024": "int", "2025": "bigint"}), ("x", "string", {"2024": "bigint", "2025": "string"})]


def test_profile_sketches_within_bounds(spark):
    df = spark.range(60_000).selectExpr("(id * 7919) % 20011 AS k", "CASE WHEN id % 4 <> 0 THEN id END AS x", "'t' || id % 300 AS t",
                                        "date_add(DATE'2020-01-01', CAST(id % 1000 AS INT)) AS d", "CAST(NULL AS STRING) AS none", "CAST(NULL AS DOUBLE) AS empty")
    parts = [profile_columns(df.where(f"x % 3 = {i}" if i else "x IS NULL OR x % 3 = 0"), f"d{i}") for i in range(3)]
    merged = merge_profiles(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for got in (merged, merge_profiles(profile_columns(df, "all"))):
        rows = {r["column"]: r for r in profile_estimates(got).collect()}
        for c in ("k", "x", "t", "d"):
            exact = df.select(c).distinct().where(f"{c} IS NOT NULL").count()
            assert abs(rows[c]["n_distinct"] - exact) <= DISTINCT_ERROR * exact, c
            assert rows[c]["n_rows"] == 60_000 and rows[c]["n_null"] == df.where(f"{c} IS NULL").count()
        for c in ("k", "x"):
            n = df.where(f"{c} IS NOT NULL").count()
            for q in (25, 50, 75):
                rank = df.where(F.col(c) <= rows[c][f"q{q}"]).count() / n
                assert abs(rank - q / 100) <= RANK_ERROR, (c, q)
        assert (rows["x"]["least_number"], rows["x"]["greatest_number"], rows["t"]["least_text"], rows["d"]["greatest_number"]) == (1.0, 59999.0, "t0", 18262.0 + 999)
        assert rows["none"]["n_null"] == rows["empty"]["n_null"] == 60_000 and rows["empty"]["q50"] is None and rows["none"]["n_distinct"] == 0
    empty = profile_estimates(profile_columns(df.limit(0), "empty")).collect()
    assert {(r["n_rows"], r["least_number"], r["q50"]) for r in empty} == {(0, None, None)}
