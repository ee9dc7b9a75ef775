"""Publication in versions, balanced files, exports side by side."""

import os
import time

import pytest
from pyspark.sql import functions as F

from fixreg.sinks import CANCELLED, ExportFailed, export_tables, publish_tables, publish_view, write_parquet


def broken(spark):
    return spark.range(5).filter("CASE WHEN id >= 0 THEN raise_error('broken table') ELSE true END")


def names(spark, db):
    return sorted(t.name for t in spark.catalog.listTables(db) if "__v" not in t.name)


def test_failed_publication_leaves_the_old_one(spark, workdir):
    for where in (None, workdir):
        db = "pub_ext" if where else "pub_own"
        publish_tables(spark, {"a-1": spark.range(3), "b": spark.range(4)}, db, location=where)
        publish_view(spark, db, "all", ["a-1", "b"])
        with pytest.raises(Exception, match="broken table"):
            publish_tables(spark, {"a-1": spark.range(9), "b": broken(spark)}, db, location=where, replace_database=True)
        assert spark.table(f"{db}.a_1").count() == 3 and spark.table(f"{db}.b").count() == 4 and spark.table(f"{db}.all").count() == 7
        assert len(spark.catalog.listTables(db)) == 5
        publish_tables(spark, {"a-1": spark.range(6)}, db, location=where)
        assert spark.table(f"{db}.all").count() == 10 and len(spark.catalog.listTables(db)) == 5
        publish_tables(spark, {"c": spark.range(1)}, db, location=where, replace_database=True, keep=["all"])
        assert names(spark, db) == ["all", "c"]
    assert len([n for n in os.listdir(workdir) if "__v" in n]) == 1  # only the newest version's files


def test_table_from_before_versions_is_replaced(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pub_old")
    spark.range(2).write.mode("overwrite").saveAsTable("pub_old.t")
    publish_tables(spark, {"t": spark.range(5)}, "pub_old")
    assert spark.table("pub_old.t").count() == 5


def test_balanced_files_under_skew(spark, workdir):
    df = spark.range(0, 90_000, 1, 9).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 2020 ELSE 2021 + id % 40 END AS jaar", "repeat(sha2(CAST(id AS STRING), 256), 2) AS t")
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "600k", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_parquet(df, f"{workdir}/t", partition_by=["jaar"], balanced=True)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    files = {}
    for r in spark.read.parquet(f"{workdir}/t").groupBy("jaar", F.input_file_name()).count().collect():
        files.setdefault(r["jaar"], []).append(r["count"])
    assert sum(files[2020]) == 30_000 and len(files[2020]) >= 4 and max(files[2020]) <= 12_000  # a third of the rows: several files
    assert sum(len(v) for y, v in files.items() if y != 2020) <= 3 * 40  # not a file of each year from each of 9 tasks
    write_parquet(df.where("jaar = 2025").withColumn("t", F.lit("new")), f"{workdir}/t", partition_by=["jaar"], balanced=True, changed_only=True)
    back = spark.read.parquet(f"{workdir}/t")
    assert back.count() == 90_000 and {r["jaar"] for r in back.where("t = 'new'").select("jaar").distinct().collect()} == {2025}
    write_parquet(df, f"{workdir}/u", balanced=True, max_rows_per_file=5_000)
    assert max(r["count"] for r in spark.read.parquet(f"{workdir}/u").groupBy(F.input_file_name()).count().collect()) <= 5_000
    with pytest.raises(ValueError, match="changed_only"):
        write_parquet(df, f"{workdir}/u", changed_only=True)


def test_exports_side_by_side(spark, workdir):
    def slow(batches):
        for b in batches:
            time.sleep(0.4)
            yield b

    tables = {f"t{i}": spark.range(i, i + 1, 1, 1).mapInArrow(slow, "id long") for i in range(8)}
    export_tables({"warm": spark.range(2).mapInArrow(slow, "id long")}, workdir)
    took = []
    for at_once in (1, 4):
        t = time.time()
        assert set(export_tables(tables, f"{workdir}/{at_once}", at_once=at_once).values()) == {"written"}
        took.append(time.time() - t)
    assert took[1] < 0.7 * took[0], took
    with pytest.raises(ExportFailed, match="broken table") as err:
        export_tables({**tables, "bad": broken(spark)}, f"{workdir}/mixed")
    assert {n for n, s in err.value.status.items() if s != "written"} == {"bad"}
    with pytest.raises(ExportFailed, match="broken table") as err:
        export_tables({"bad": broken(spark), **tables}, f"{workdir}/stopped", at_once=2, cancel_on_failure=True)
    stopped = [n for n, s in err.value.status.items() if s == CANCELLED]
    assert len(stopped) >= 4 and not any(os.path.exists(f"{workdir}/stopped/{n}") for n in stopped)
    assert export_tables({}, workdir) == {}
