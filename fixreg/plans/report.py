"""Input-coverage report (R1), built to the intent of the register tool's
``qa`` command, which cannot run as written (ledger L30).

Which input entries resolve to which layout, what each holds (records,
shortest/longest record, records with undeclared trailing data) and which
layouts have no input.  One text scan over all readable entries, one
aggregation per entry, a full outer join with the layout list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.functions.exprs import BLANKS, cell
from fixreg.sources.fixed_width import ENCODING, list_inputs
from fixreg.sources.layout import Layout, layouts_in

MISSING = "❌"


def layout_table(spark: SparkSession, layouts: dict[str, Layout]) -> DataFrame:
    rows = [(n, lay.record_width, len(lay.columns)) for n, lay in layouts.items()]
    schema = T.StructType([
        T.StructField("layout", T.StringType()),
        T.StructField("record_width", T.LongType()),
        T.StructField("n_columns", T.LongType()),
    ])
    return spark.createDataFrame(rows, schema)


def feed_report(spark: SparkSession, source_dir: str, layouts: dict[str, Layout] | None = None,
                encoding: str = ENCODING) -> DataFrame:
    """One row per input entry and per layout without input.

    Columns: ``entry``, ``layout``, ``bytes``, ``records``, ``min_length``,
    ``max_length``, ``garbage_records``; a missing entry or layout is ``❌``.
    """
    layouts = layouts or layouts_in()
    entries = list_inputs(spark, source_dir, list(layouts))
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(source_dir)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root)
    base = root.toUri().getPath().rstrip("/") + "/"
    ent_schema = T.StructType([
        T.StructField("entry", T.StringType()),
        T.StructField("layout", T.StringType()),
        T.StructField("bytes", T.LongType()),
    ])
    ent = spark.createDataFrame([(e.name, e.layout, e.bytes) for e in entries], ent_schema)
    lay = layout_table(spark, layouts)

    readable = [e.path for e in entries if e.bytes > 0]
    if readable:
        text = spark.read.text(readable)
        line = F.decode(F.col("value").cast("binary"), encoding)
        # The file's path without scheme and host, as the root's; the reader gives it URL-encoded.
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        path = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
        inside = F.substr(path, F.lit(len(base) + 1))
        lines = text.select(F.substring_index(inside, "/", 1).alias("entry"), line.alias("line"))
        lines = lines.filter(F.length(F.btrim("line", F.lit(BLANKS))) > 0)
        widths = ent.join(lay, "layout").select("entry", "record_width")
        probe = cell(F.substr(F.col("line"), F.col("record_width") + 1, F.lit(2**31 - 1)))
        stats = (
            lines.join(widths, "entry", "left")  # one row per entry
            .groupBy("entry")
            .agg(
                F.count(F.lit(1)).alias("records"),
                F.min(F.length("line")).cast("bigint").alias("min_length"),
                F.max(F.length("line")).cast("bigint").alias("max_length"),
                F.count(probe).alias("garbage_records"),
            )
        )
        ent = ent.join(stats, "entry", "left")
    else:
        ent = ent.select("*", *[F.lit(None).cast("bigint").alias(c)
                                for c in ("records", "min_length", "max_length", "garbage_records")])
    # Layouts without any entry come from the outer side of this join (the
    # union of "files" and "layouts without file", G9); missing → ❌.
    report = ent.join(lay.select("layout"), "layout", "full_outer")
    return report.select(
        F.coalesce("entry", F.lit(MISSING)).alias("entry"),
        F.coalesce("layout", F.lit(MISSING)).alias("layout"),
        "bytes", "records", "min_length", "max_length", "garbage_records",
    )
