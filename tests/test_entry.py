"""Driver contract, plan properties, sinks and report."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fixreg.plans import driver_queries as Q
from fixreg.plans.driver_queries import QUERIES
from fixreg.plans.report import feed_report
from fixreg.sinks import ExportFailed, export_folder, export_tables
from fixreg.sources.layout import ColumnSpec, Layout

SF = "/root/testdata/sf0.001"
PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "students" in df.columns


def test_every_register_query_has_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_no_python_in_plans(spark):
    for name in ("enriched_enrolments", "exam_grades", "fwf_roundtrip_customer", "classify_text"):
        plan = Q.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(n in plan for n in PY_NODES), name


def test_scan_prunes_columns(spark):
    plan = Q.lookup_join_checked(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "c_mktsegment" not in plan


def test_export_skips_empty(spark, workdir):
    df = spark.range(3)
    status = export_tables({"a-b": df, "leeg": df.filter("id < 0")}, workdir, "csv")
    assert status == {"a-b": "written", "leeg": "empty, skipped"}
    assert os.path.isdir(os.path.join(workdir, "a_b"))


def test_feed_report_lists_missing(spark):
    rows = {(r["entry"], r["layout"]): r for r in Q.feed_report_query(spark, SF).collect()}
    assert rows[("❌", "VAKHAVW_leeg")]["records"] is None
    assert rows[("notes.txt", "❌")]["records"] == 5


def test_feed_report_empty_dir(spark, workdir):
    open(os.path.join(workdir, "Dec_isat.asc"), "w").close()
    rows = feed_report(spark, workdir).collect()
    assert len(rows) == 20 and any(r["entry"] == "Dec_isat.asc" for r in rows)


def test_lookups_broadcast_when_small(spark):
    df = Q.enriched_enrolments(spark, SF)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in plan


def test_export_computes_each_table_once(spark, workdir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(count, "id long").repartition(3)
    assert export_tables({"a": df}, workdir) == {"a": "written"}
    assert seen.value == 1000


def test_export_failure_is_raised_and_leaves_no_target(spark, workdir):
    bad = spark.range(10).filter("CASE WHEN id = 7 THEN raise_error('bad row') ELSE true END")
    with pytest.raises(ExportFailed, match="bad row") as err:
        export_tables({"bad": bad, "good": spark.range(3)}, workdir)
    assert err.value.status["good"] == "written"
    assert sorted(n for n in os.listdir(workdir) if not n.startswith(".")) == ["good"]


def test_export_folder(spark, workdir):
    spark.range(3).write.parquet(f"{workdir}/in/t")
    assert export_folder(spark, f"{workdir}/in", f"{workdir}/out") == {"t": "written"}
    assert spark.read.option("header", True).csv(f"{workdir}/out/t").count() == 3


def test_feed_report_path_spellings(spark, workdir):
    os.mkdir(f"{workdir}/a+b c")
    with open(f"{workdir}/a+b c/Dec_test.asc", "w") as f:
        f.write("0001x\n0002y          TAIL\n")
    lay = {"Dec_test": Layout("Dec_test", (ColumnSpec("k", 1, 4, "bigint"), ColumnSpec("v", 5, 1)))}
    folder = f"{workdir}/a+b c"
    for path in (folder, folder + "/", f"file://{folder}", f"file:{folder}", folder.replace("/tmp/", "/tmp//"), os.path.relpath(folder)):
        r = feed_report(spark, path, lay).first()
        assert (r["records"], r["garbage_records"]) == (2, 1), path
