"""Check queries: every operator of the library run on the shared test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose
columns match the oracle SQL of the same name (``driver_sql``).  Integer
outputs are normalised to bigint so both engines report the same types.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.functions.codes import classify_prior_education, profile_of
from fixreg.functions.converters import register_converter
from fixreg.operators.joins import (
    anti_join,
    assert_unique,
    duplicate_keys,
    lookup_join,
    member_flag,
    require_not_null,
)
from fixreg.operators.privacy import add_local_id, crosswalk, pseudonymise
from fixreg.operators.profile import merge_profiles, profile_columns
from fixreg.operators.reshape import unpivot_non_null
from fixreg.plans import cohort as K
from fixreg.plans import driver_views as V
from fixreg.plans import enrich as E
from fixreg.plans import exams as X
from fixreg.plans.assets import LOCAL_NAME_COLUMNS, convert_register, converted_tables, create_assets
from fixreg.plans.report import feed_report
from fixreg.session import remove_path, scratch_path
from fixreg.sinks import export_tables, publish_tables, publish_view, write_csv, write_parquet
from fixreg.sources.delimited import parse_delimited, read_delimited
from fixreg.sources.fixed_width import garbage_rows, parse_fixed_width, read_directory, read_editions
from fixreg.sources.layout import ColumnSpec, Layout, LayoutEditions
from fixreg.streaming import convert_stream

SALT = "fixreg-check-salt"
PGN = "PersoonsgebondenNummer"


def norm(df: DataFrame) -> DataFrame:
    """Integers → bigint, floats → double (type parity with the oracle)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------------------
# Fixed-width inputs built from the tables
# ---------------------------------------------------------------------------

CUSTOMER_LAYOUT = Layout("Dec_klant", (
    ColumnSpec("c_custkey", 1, 10, "bigint"),
    ColumnSpec("c_name", 11, 25, "string"),
    ColumnSpec("c_nationkey", 36, 3, "bigint"),
    ColumnSpec("c_mktsegment", 39, 10, "string"),
))
CUSTOMER_LINE = (
    "lpad(CAST(c_custkey AS STRING), 10, '0') || rpad(coalesce(c_name, ''), 25, ' ') "
    "|| lpad(CAST(c_nationkey AS STRING), 3, ' ') || rpad(coalesce(c_mktsegment, ''), 10, ' ')"
)
ORDERS_LAYOUT = Layout("EVorders", (
    ColumnSpec("o_orderkey", 1, 10, "bigint"),
    ColumnSpec("o_custkey", 11, 10, "bigint"),
    ColumnSpec("o_orderstatus", 21, 1, "string"),
    ColumnSpec("o_orderdate", 22, 8, "date"),
    ColumnSpec("o_orderpriority", 30, 15, "string"),
))
ORDERS_LINE = (
    "lpad(CAST(o_orderkey AS STRING), 10, '0') || lpad(CAST(o_custkey AS STRING), 10, '0') || o_orderstatus "
    "|| date_format(o_orderdate, 'yyyyMMdd') || rpad(o_orderpriority, 15, ' ')"
)


def customer_lines(spark, d) -> DataFrame:
    return V.table(spark, d, "customer").selectExpr(f"{CUSTOMER_LINE} AS __line")


def fwf_roundtrip_customer(spark, d):
    return norm(parse_fixed_width(customer_lines(spark, d), CUSTOMER_LAYOUT))


def fwf_untyped(spark, d):
    return parse_fixed_width(customer_lines(spark, d), CUSTOMER_LAYOUT, typed=False)


def fwf_unknown_converter(spark, d):
    lay = Layout("Dec_klant", tuple(
        ColumnSpec(c.name, c.start, c.width, "convert_to_mystery" if c.name == "c_nationkey" else c.converter)
        for c in CUSTOMER_LAYOUT.columns))
    return norm(parse_fixed_width(customer_lines(spark, d), lay).select("c_custkey", "c_nationkey"))


GAPPED_LAYOUT = Layout("Dec_klant_gat", (
    ColumnSpec("c_custkey", 1, 10, "bigint"),
    ColumnSpec("c_name", 13, 25, "string"),  # two filler positions before the name
    ColumnSpec("c_nationkey", 38, 3, "bigint"),
))


def fwf_declared_offsets(spark, d):
    """Cut by declared starts (a layout with a filler gap, ledger L6)."""
    line = ("lpad(CAST(c_custkey AS STRING), 10, '0') || '**' || rpad(coalesce(c_name, ''), 25, ' ') "
            "|| lpad(CAST(c_nationkey AS STRING), 3, ' ')")
    lines = V.table(spark, d, "customer").selectExpr(f"{line} AS __line")
    return norm(parse_fixed_width(lines, GAPPED_LAYOUT, offsets="declared"))


def fwf_na_values(spark, d):
    """pandas-compatible missing markers on request (ledger L5): ``NA`` → null."""
    line = ("lpad(CAST(c_custkey AS STRING), 10, '0') || rpad(coalesce(c_name, ''), 25, ' ') || "
            "CASE WHEN c_custkey % 7 = 0 THEN ' NA' ELSE lpad(CAST(c_nationkey AS STRING), 3, ' ') END || "
            "rpad(CASE WHEN c_custkey % 5 = 0 THEN 'NA' ELSE coalesce(c_mktsegment, '') END, 10, ' ')")
    lines = V.table(spark, d, "customer").selectExpr(f"{line} AS __line")
    out = parse_fixed_width(lines, CUSTOMER_LAYOUT, typed=False, na_values=("NA",))
    return out.select("c_custkey", "c_nationkey", "c_mktsegment")


def fwf_bad_values(spark, d):
    """A number column with letters on some rows: null, not a failed file (L4)."""
    line = ("lpad(CAST(c_custkey AS STRING), 10, '0') || rpad(coalesce(c_name, ''), 25, ' ') || "
            "CASE WHEN c_custkey % 9 = 0 THEN 'X' || lpad(CAST(c_nationkey % 100 AS STRING), 2, '0') "
            "ELSE lpad(CAST(c_nationkey AS STRING), 3, ' ') END || rpad(coalesce(c_mktsegment, ''), 10, ' ')")
    lines = V.table(spark, d, "customer").selectExpr(f"{line} AS __line")
    return norm(parse_fixed_width(lines, CUSTOMER_LAYOUT).select("c_custkey", "c_nationkey"))


PART_LAYOUT = Layout("Dec_onderdeel", (
    ColumnSpec("p_partkey", 1, 8, "bigint"),
    ColumnSpec("p_brand", 9, 10, "string"),
))
PART_LINE = ("lpad(CAST(p_partkey AS STRING), 8, '0') || rpad(p_brand, 10, ' ') || "
             "CASE WHEN p_type = 'PROMO' THEN 'XTRA' || CAST(p_size AS STRING) ELSE '' END")


def _part_lines(spark, d):
    return V.table(spark, d, "part").selectExpr(f"{PART_LINE} AS __line")


def fwf_garbage_rows(spark, d):
    bad = garbage_rows(_part_lines(spark, d), PART_LAYOUT)
    return norm(bad.select(F.substring("record", 1, 8).cast("bigint").alias("p_partkey"), "GarbageColumn"))


def garbage_examples(spark, d):
    """The first ten records with trailing data, by key."""
    return fwf_garbage_rows(spark, d).orderBy("p_partkey").limit(10)


def fwf_garbage_keep(spark, d):
    """Garbage kept as a column (reference behaviour) on every record."""
    return norm(parse_fixed_width(_part_lines(spark, d), PART_LAYOUT, on_garbage="keep"))


def fwf_quarantine(spark, d):
    return norm(parse_fixed_width(_part_lines(spark, d), PART_LAYOUT, on_garbage="quarantine"))


DATES_LAYOUT = Layout("Dec_datums", (
    ColumnSpec("o_orderkey", 1, 10, "bigint"),
    ColumnSpec("o_orderdate", 11, 8, "date"),
    ColumnSpec("code", 19, 3, "bigint_zero_null"),
))


def fwf_dates_zero_null(spark, d):
    line = ("lpad(CAST(o_orderkey AS STRING), 10, '0') || CASE WHEN o_orderstatus = 'P' THEN '00000000' "
            "ELSE date_format(o_orderdate, 'yyyyMMdd') END || lpad(CAST(o_orderkey % 100 AS STRING), 3, '0')")
    lines = V.table(spark, d, "orders").selectExpr(f"{line} AS __line")
    return norm(parse_fixed_width(lines, DATES_LAYOUT))


FLOAT_LAYOUT = Layout("Dec_bedrag", (
    ColumnSpec("l_orderkey", 1, 10, "bigint"),
    ColumnSpec("l_linenumber", 11, 2, "bigint"),
    ColumnSpec("l_extendedprice", 13, 24, "double"),
    ColumnSpec("l_comment", 37, 5, "null"),
))


def _lineitem_float_lines(spark, d):
    line = ("lpad(CAST(l_orderkey AS STRING), 10, '0') || lpad(CAST(l_linenumber AS STRING), 2, '0') || "
            "rpad(CAST(l_extendedprice AS STRING), 24, ' ') || 'abcde'")
    return V.table(spark, d, "lineitem").selectExpr(f"{line} AS __line")


def fwf_float(spark, d):
    return norm(parse_fixed_width(_lineitem_float_lines(spark, d), FLOAT_LAYOUT)
                .select("l_orderkey", "l_linenumber", "l_extendedprice"))


def conv_null(spark, d):
    return norm(parse_fixed_width(_lineitem_float_lines(spark, d), FLOAT_LAYOUT)
                .select("l_orderkey", "l_linenumber", "l_comment"))


RECODE_LAYOUT = Layout("Dec_codes", (
    ColumnSpec("l_orderkey", 1, 10, "bigint"),
    ColumnSpec("l_linenumber", 11, 2, "bigint"),
    ColumnSpec("Geslacht", 13, 1, "convert_geslacht"),
    ColumnSpec("Opleidingsvorm", 14, 1, "convert_opleidingsvorm"),
))


def _recode_lines(spark, d):
    line = ("lpad(CAST(l_orderkey AS STRING), 10, '0') || lpad(CAST(l_linenumber AS STRING), 2, '0') || "
            "CASE l_returnflag WHEN 'A' THEN 'M' WHEN 'R' THEN 'V' ELSE ' ' END || "
            "CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN ' ' ELSE CAST(l_linenumber AS STRING) END")
    return V.table(spark, d, "lineitem").selectExpr(f"{line} AS __line")


def recode_two_codes(spark, d):
    return norm(parse_fixed_width(_recode_lines(spark, d), RECODE_LAYOUT)
                .select("l_orderkey", "l_linenumber", "Geslacht"))


def recode_int_codes(spark, d):
    return norm(parse_fixed_width(_recode_lines(spark, d), RECODE_LAYOUT)
                .select("l_orderkey", "l_linenumber", "Opleidingsvorm"))


register_converter("cents_to_amount", T.DoubleType(), lambda c: c.try_cast("bigint") / F.lit(100.0))
CENTS_LAYOUT = Layout("Dec_centen", (
    ColumnSpec("o_orderkey", 1, 10, "bigint"),
    ColumnSpec("amount", 11, 14, "cents_to_amount"),
))


def custom_converter(spark, d):
    line = ("lpad(CAST(o_orderkey AS STRING), 10, '0') || "
            "lpad(CAST(CAST(floor(o_totalprice * 100) AS BIGINT) AS STRING), 14, '0')")
    lines = V.table(spark, d, "orders").selectExpr(f"{line} AS __line")
    return norm(parse_fixed_width(lines, CENTS_LAYOUT))


# Input folder with two kinds of records and a file without a layout.
KIND_LAYOUTS = {
    "EVorders": ORDERS_LAYOUT,
    "Dec_klant": CUSTOMER_LAYOUT,
    "VAKHAVW_leeg": Layout("VAKHAVW_leeg", (ColumnSpec("x", 1, 4, "string"),)),
}


KIND_NAME = "replace(c_name, 'Customer', 'Cliënt')"


def _write_kind_folder(spark, d) -> str:
    root = scratch_path(spark, "kinds")
    V.table(spark, d, "orders").selectExpr(f"{ORDERS_LINE} AS value").write.text(f"{root}/EV21XX_orders.asc")
    # Latin-1 with a character outside ASCII, as the register's own files.
    line = CUSTOMER_LINE.replace("c_name", KIND_NAME)
    V.table(spark, d, "customer").selectExpr(f"{line} AS value").write.options(
        encoding="ISO-8859-1", sep="\x01", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/dec_KLANT.asc")
    V.table(spark, d, "region").selectExpr("r_name AS value").write.text(f"{root}/notes.txt")
    return root


def fwf_by_kind(spark, d):
    scan = read_directory(spark, _write_kind_folder(spark, d), KIND_LAYOUTS, on_garbage="fail")
    parts = [t.drop("source_file").withColumn("layout", F.lit(n)) for n, t in sorted(scan.tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)  # G9
    return norm(out)


def feed_report_query(spark, d):
    rep = feed_report(spark, _write_kind_folder(spark, d), KIND_LAYOUTS)
    return norm(rep.select("entry", "layout", "records", "garbage_records"))


def delimited_lookup(spark, d):
    lines = V.table(spark, d, "nation").selectExpr(
        "concat_ws(';', lpad(CAST(n_nationkey AS STRING), 3, '0'), n_name, CAST(n_regionkey AS STRING)) AS line")
    return parse_delimited(lines, "line", ["NationCode", "NationName", "RegionCode"])


def delimited_file(spark, d):
    """A delimited file with a header, read with leading zeros and accents kept."""
    path = scratch_path(spark, "delimited")
    V.table(spark, d, "nation").selectExpr(
        "lpad(CAST(n_nationkey AS STRING), 3, '0') AS NationCode", "n_name || ' é' AS NationName",
        "CAST(n_regionkey AS STRING) AS RegionCode").write.option("header", True).option("sep", ";").csv(path)
    return read_delimited(spark, path, ["NationCode", "NationName", "RegionCode"])


FAR_LINE = ("lpad(CAST(p_partkey AS STRING), 8, '0') || rpad(p_brand, 10, ' ') || "
            "CASE WHEN p_size > 40 THEN '               ver ' || CAST(p_size AS STRING) ELSE '' END")


def fwf_garbage_far(spark, d):
    """Undeclared data behind a long blank stretch is found by default."""
    lines = V.table(spark, d, "part").selectExpr(f"{FAR_LINE} AS __line")
    return norm(garbage_rows(lines, PART_LAYOUT).select(F.expr("CAST(substr(record, 1, 8) AS BIGINT)").alias("p_partkey"), "GarbageColumn"))


def converted_years(spark, d):
    """All converted tables of a prefix, not the first; a later one has a column more."""
    root = scratch_path(spark, "years")
    orders = V.table(spark, d, "orders")
    orders.where("year(o_orderdate) % 2 = 0").select("o_orderkey", "o_orderstatus").write.parquet(f"{root}/EV_2024")
    orders.where("year(o_orderdate) % 2 = 1").select("o_orderkey", "o_orderstatus", "o_custkey").write.parquet(f"{root}/EV_2025")
    V.table(spark, d, "region").write.parquet(f"{root}/Dec_regio")
    return norm(converted_tables(spark, root, "EV"))


def _converted(spark, inputs: dict[str, DataFrame], **options):
    """Lines as an extract folder, converted; the status and the folders of the tables and of records set apart."""
    root = scratch_path(spark, "convert")
    for name, lines in inputs.items():
        lines.select(F.col(lines.columns[0]).alias("value")).write.text(f"{root}/in/{name}")
    try:
        status = convert_register(spark, f"{root}/in", f"{root}/out", quarantine_dir=f"{root}/apart", **options)
    finally:
        remove_path(spark, f"{root}/in")
    return status, f"{root}/out", f"{root}/apart"


def convert_quarantine(spark, d):
    """The conversion's two tables of one pass: good rows, and records set apart as they came; together all records."""
    status, out, apart = _converted(spark, {"Dec_onderdeel.asc": _part_lines(spark, d)}, layouts={"Dec_onderdeel": PART_LAYOUT},
                                    remove_pii=False, on_garbage="quarantine")
    assert status["Dec_onderdeel"].startswith("written"), status
    good = spark.read.parquet(f"{out}/Dec_onderdeel").select("p_partkey", "p_brand", F.lit(None).cast("string").alias("GarbageColumn"))
    bad = spark.read.parquet(f"{apart}/Dec_onderdeel").select(F.substring("record", 1, 8).cast("bigint").alias("p_partkey"),
                                                              F.lit(None).cast("string").alias("p_brand"), "GarbageColumn")
    return norm(good.unionByName(bad))


def conversion_accounts(spark, d):
    """What the conversion says of the cells it could not read, by column."""
    line = ("lpad(CAST(c_custkey AS STRING), 10, '0') || rpad(coalesce(c_name, ''), 25, ' ') || "
            "CASE WHEN c_custkey % 500 = 0 THEN 'X03' ELSE lpad(CAST(c_nationkey AS STRING), 3, ' ') END || rpad(coalesce(c_mktsegment, ''), 10, ' ')")
    status, out, _ = _converted(spark, {"Dec_klant.asc": V.table(spark, d, "customer").selectExpr(f"{line} AS l")},
                                layouts={"Dec_klant": CUSTOMER_LAYOUT}, remove_pii=False)
    account = status.accounts["Dec_klant"]
    nulls = spark.read.parquet(f"{out}/Dec_klant").agg(F.count_if(F.col("c_nationkey").isNull()).alias("null_cells"))
    said = spark.createDataFrame([("Dec_klant", c, n, account.records, status["Dec_klant"]) for c, n in account.bad_cells.items()],
                                 "table_name string, column_name string, unreadable bigint, records bigint, status string")
    return norm(said.join(nulls))


def convert_local_ids(spark, d):
    """The institution's own ids attached by the conversion to enrolment and exam tables, before ids are pseudonymised."""
    lay = {n: Layout(n, (ColumnSpec(PGN, 1, 12, "string"), ColumnSpec("nummer", 13, 10, "bigint"))) for n in ("EVlokaal", "VAKHAVlokaal")}
    line = "lpad(CAST({} AS STRING), 12, '0') || lpad(CAST({} AS STRING), 10, '0') AS l"
    local = V.table(spark, d, "customer").where("c_custkey % 2 = 0").selectExpr(
        "lpad(CAST(c_custkey AS STRING), 12, '0') AS pgn_lokaal", "'S' || CAST(c_custkey AS STRING) AS studentnummer")
    _, out, _ = _converted(spark, {
        "EVlokaal.asc": V.table(spark, d, "orders").selectExpr(line.format("o_custkey", "o_orderkey")),
        "VAKHAVlokaal.asc": V.table(spark, d, "customer").selectExpr(line.format("c_custkey", "c_nationkey")),
    }, layouts=lay, salt=SALT, local_ids=local, local_id_keys=(PGN, "pgn_lokaal"))
    tables = [spark.read.parquet(f"{out}/{n}").drop("source_file").withColumn("tabel", F.lit(n)) for n in lay]
    return norm(tables[0].unionByName(tables[1]))


EDITIONS = {
    "Dec_adres_2023": Layout("Dec_adres_2023", (ColumnSpec("c_custkey", 1, 10, "bigint"), ColumnSpec("c_name", 11, 25), ColumnSpec("c_nationkey", 36, 3, "bigint"))),
    "Dec_adres_2025": Layout("Dec_adres_2025", (ColumnSpec("c_custkey", 1, 12, "bigint"), ColumnSpec("c_nationkey", 13, 4, "string"),
                                                ColumnSpec("c_mktsegment", 17, 10), ColumnSpec("c_name", 27, 25))),
}


def dated_layouts(spark, d):
    """Files of three years in one scan, each cut by the layout of its year (2024 still by that of 2023)."""
    root = scratch_path(spark, "editions")
    old = "lpad(CAST(c_custkey AS STRING), 10, '0') || rpad(coalesce(c_name, ''), 25, ' ') || lpad(CAST(c_nationkey AS STRING), 3, ' ') AS value"
    new = ("lpad(CAST(c_custkey AS STRING), 12, '0') || 'N' || lpad(CAST(c_nationkey AS STRING), 3, '0') || rpad(coalesce(c_mktsegment, ''), 10, ' ') "
           "|| rpad(coalesce(c_name, ''), 25, ' ') AS value")
    for year, line in ((2023, old), (2024, old), (2025, new)):
        V.table(spark, d, "customer").where(f"c_custkey % 3 = {year % 3}").selectExpr(line).write.text(f"{root}/dec_ADRES_{year}.txt")
    return norm(read_editions(spark, root, LayoutEditions.of(EDITIONS)).tables["Dec_adres"].drop("source_file"))


def converted_types(spark, d):
    """Deliveries whose column types differ, read as one table: a number and a text meet as text, a date and a text too."""
    root = scratch_path(spark, "types")
    orders = V.table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    orders.where("o_orderkey % 2 = 0").selectExpr("o_orderkey", "CAST(o_custkey AS INT) AS klant", "day").write.parquet(f"{root}/EV_2024")
    orders.where("o_orderkey % 2 = 1").selectExpr("CAST(o_orderkey AS INT) AS o_orderkey", "'K' || o_custkey AS klant", "date_format(day, 'dd-MM-yyyy') AS day").write.parquet(f"{root}/EV_2025")
    return norm(converted_tables(spark, root, "EV"))


def stream_roundtrip_customer(spark, d):
    """Fixed-width files converted by the streaming reader (availableNow)."""
    src = scratch_path(spark, "landing")
    customer_lines(spark, d).selectExpr("__line AS value").write.text(src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = convert_stream(spark, src, CUSTOMER_LAYOUT, out, ckpt)
    q.awaitTermination()
    return norm(spark.read.parquet(out).drop("source_file"))


# ---------------------------------------------------------------------------
# Privacy
# ---------------------------------------------------------------------------

def _customer_people(spark, d):
    return V.table(spark, d, "customer").selectExpr(
        "lpad(CAST(c_custkey AS STRING), 12, '0') AS PersoonsgebondenNummer", "c_nationkey",
        "c_name AS Burgerservicenummer")


def _order_people(spark, d):
    return V.table(spark, d, "orders").selectExpr(
        "o_orderkey", "lpad(CAST(o_custkey AS STRING), 12, '0') AS PersoonsgebondenNummer",
        "CAST(o_orderkey AS STRING) AS Onderwijsnummer")


def crosswalk_permute(spark, d):
    return crosswalk(_customer_people(spark, d), PGN, salt=SALT)


def pseudonymise_two_tables(spark, d):
    t = pseudonymise({"orders": _order_people(spark, d), "customer": _customer_people(spark, d)},
                     salt=SALT, mode="permute")
    o, c = t["orders"], t["customer"].withColumnRenamed(PGN, "__c")
    j = o.join(c, F.col(PGN) == F.col("__c"), "left")
    return norm(j.select("o_orderkey", PGN, "c_nationkey", "Onderwijsnummer", "Burgerservicenummer"))


def pseudonymise_hash(spark, d):
    t = pseudonymise({"orders": _order_people(spark, d)}, salt=SALT, mode="hash")
    return norm(t["orders"])


def add_local_id_query(spark, d):
    local = V.table(spark, d, "customer").selectExpr(
        "lpad(CAST(c_custkey AS STRING), 12, '0') AS pgn_local", "'S' || CAST(c_custkey AS STRING) AS studentnummer")
    return norm(add_local_id(_order_people(spark, d), local, PGN, "pgn_local")
                .select("o_orderkey", PGN, "studentnummer"))


# ---------------------------------------------------------------------------
# Joins and checks
# ---------------------------------------------------------------------------

def lookup_join_checked(spark, d):
    nation = assert_unique(V.table(spark, d, "nation"), ["n_nationkey"], "nation")  # eager J2
    region = V.table(spark, d, "region")
    c = V.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = lookup_join(c, nation, [("c_nationkey", "n_nationkey")], name="nation")
    j = require_not_null(j, "n_name", "nation")
    j = lookup_join(j, region, [("n_regionkey", "r_regionkey")], unique_right=True, name="region")  # lazy J2
    return norm(require_not_null(j, "r_name", "region").select("c_custkey", "n_name", "r_name"))


def lookup_join_null_keys(spark, d):
    c = V.table(spark, d, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS k")
    n = V.table(spark, d, "nation").selectExpr(
        "CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey END AS k", "n_name")
    return norm(lookup_join(c, n, ["k"], name="nation"))


def _first_year_awards(spark, d):
    o = V.table(spark, d, "orders").withColumn("yr", F.year("o_orderdate"))
    fy = o.groupBy("o_custkey").agg(F.min("yr").alias("first_yr"))
    return o.join(fy, "o_custkey").filter((F.col("o_orderstatus") == "F") & (F.col("yr") == F.col("first_yr")))


def member_flag_query(spark, d):
    c = V.table(spark, d, "customer").select("c_custkey")
    return norm(member_flag(c, _first_year_awards(spark, d), [("c_custkey", "o_custkey")], "award_in_first_year"))


def anti_join_query(spark, d):
    c = V.table(spark, d, "customer").select("c_custkey")
    return norm(anti_join(c, _first_year_awards(spark, d), [("c_custkey", "o_custkey")]))


def duplicate_key_report(spark, d):
    li = V.table(spark, d, "lineitem")
    return norm(duplicate_keys(li, ["l_orderkey", "l_linenumber"]))


def column_profile(spark, d):
    """Every column of two deliveries of ``lineitem`` profiled in one pass each, and the stored profiles merged."""
    root = scratch_path(spark, "profile")
    li = V.table(spark, d, "lineitem").withColumn("l_suppkey", F.expr("CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END"))
    for k in (0, 1):
        profile_columns(li.where(f"l_orderkey % 2 = {k}"), f"delivery {k}", ["l_orderkey", "l_suppkey", "l_quantity", "l_returnflag"]).write.parquet(f"{root}/delivery={k}")
    merged = merge_profiles(spark.read.parquet(root))
    return norm(merged.select("column", "n_deliveries", "n_rows", "n_null", "least_number", "greatest_number", "least_text", "greatest_text"))


def key_profile(spark, d):
    """Row count, distinct, null and non-null counts, maximum — one pass."""
    li = V.table(spark, d, "lineitem")
    return norm(li.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("l_orderkey").alias("n_keys"),
        F.count_if(F.col("l_suppkey").isNull()).alias("n_null"),
        F.count("l_suppkey").alias("n_not_null"),
        F.max("l_orderkey").alias("max_key"),
    ))


# ---------------------------------------------------------------------------
# Enrichment
# ---------------------------------------------------------------------------

def classify_text(spark, d):
    p = V.table(spark, d, "part").selectExpr("p_partkey", f"{V.phrase_expr('p_partkey')} || ' ' || p_name AS tekst")
    return norm(p.select("p_partkey", classify_prior_education("tekst").alias("Vooropleiding")))


def map_profile(spark, d):
    p = V.table(spark, d, "part").selectExpr("p_partkey", f"{V.PRIOR_CODE_OF_PART} AS code")
    return norm(p.select("p_partkey", "code", profile_of("code").alias("Profiel")))


def _enrolment(spark, d):
    return V.enrolment(spark, d).withColumn("Aantal", F.lit(1))


def enrich_by_code(spark, d):
    lk = V.lookups(spark, d, with_local_names=False)
    e = E.add_prior_education(_enrolment(spark, d), lk.dec_vopl)
    e = E.add_programme_name(e, lk.dec_isat)
    return norm(e.select(PGN, "Inschrijvingsjaar", "HoogsteVooropleidingCode", "HoogsteVooropleidingVolledig",
                         "HoogsteVooropleidingProfiel", "Vooropleiding", "NaamOpleidingCroho"))


def two_key_lookup(spark, d):
    lk = V.lookups(spark, d, with_local_names=False)
    e = E.add_prior_institution(_enrolment(spark, d), lk.dec_brinvestigingsnummer)
    return norm(e.select(PGN, "Inschrijvingsjaar", "InstellingVanDeHoogsteVooropleiding",
                         "VestigingsnummerVanDeHoogsteVooropleiding", "NaamInstellingHoogsteVooropleiding",
                         "PlaatsInstellingHoogsteVooropleiding", "DatumOprichtingInstellingHoogsteVooropleiding"))


def two_key_lookup_kinds(spark, d):
    """E4 for the prior education before and within higher education: each kind's attributes under its own names."""
    lk = V.lookups(spark, d, with_local_names=False)
    e = _enrolment(spark, d).withColumns({
        "InstellingVanDeHoogsteVooroplVoorHetHo": F.col("InstellingVanDeHoogsteVooropleiding"),
        "VestigingsnummerVanDeHoogsteVooroplVoorHetHo": F.lit("00"),
        "InstellingVanDeHoogsteVooroplBinnenHetHo": F.lit("0017"),
        "VestigingsnummerVanDeHoogsteVooroplBinnenHetHo": F.col("VestigingsnummerVanDeHoogsteVooropleiding"),
    })
    for kind in E.PRIOR_KINDS[1:]:
        e = E.add_prior_institution(e, lk.dec_brinvestigingsnummer, kind)
    return norm(e.select(PGN, "Inschrijvingsjaar", "InstellingVanDeHoogsteVooropleiding", "VestigingsnummerVanDeHoogsteVooropleiding",
                         "NaamInstellingHoogsteVooroplVoorHetHo", "PlaatsInstellingHoogsteVooroplVoorHetHo",
                         "NaamInstellingHoogsteVooroplBinnenHetHo", "DatumOprichtingInstellingHoogsteVooroplBinnenHetHo"))


def coalesce_code(spark, d):
    return norm(E.add_programme(_enrolment(spark, d)).select(PGN, "Inschrijvingsjaar", "opleiding"))


def recode_default_unknown(spark, d):
    e = E.add_programme_type(E.add_sector(_enrolment(spark, d)))
    return norm(e.select(PGN, "Inschrijvingsjaar", "CrohoOnderdeel", "TypeOpleiding"))


def recode_keep_unmapped(spark, d):
    e = E.add_diploma_kind(_enrolment(spark, d))
    return norm(e.select(PGN, "Inschrijvingsjaar", "SoortDiploma"))


def first_year_award_flag(spark, d):
    return norm(E.first_year_degree(_enrolment(spark, d)).select(PGN, "Inschrijvingsjaar", "HoDiplomaInEersteJaar"))


def local_names_unmatched(spark, d):
    lk = V.lookups(spark, d)
    e = E.add_programme_name(_enrolment(spark, d), lk.dec_isat)
    return E.programmes_without_local_name(e, lk.local_names)


def local_names_join(spark, d):
    lk = V.lookups(spark, d)
    e = E.add_local_names(_enrolment(spark, d), lk.local_names)
    return norm(e.select(PGN, "Inschrijvingsjaar", "CodeOpleiding", "NaamOpleiding", "NaamFaculteit",
                         "CodeFaculteit"))


def assets_unmatched_report(spark, d):
    """The report of programmes without a local name, as the assets' job writes it."""
    root, lk = scratch_path(spark, "assets"), V.lookups(spark, d)
    for name, df in (("EV____24", V.enrolment(spark, d)), ("Dec_vopl", lk.dec_vopl), ("Dec_brinvestigingsnummer", lk.dec_brinvestigingsnummer),
                     ("Dec_isat", lk.dec_isat), ("Dec_ho_ISCED", lk.dec_ho_isced)):
        df.write.parquet(f"{root}/in/{name}")
    lk.local_names.select(*LOCAL_NAME_COLUMNS).write.option("header", True).option("sep", ";").csv(f"{root}/names")
    written = create_assets(spark, f"{root}/in", f"{root}/out", local_names_path=f"{root}/names")
    remove_path(spark, f"{root}/in")
    return spark.read.parquet(written["programmes_without_local_name"])


def seven_predicate_cohort(spark, d):
    return norm(E.add_pa_cohort(_enrolment(spark, d)).select(PGN, "Inschrijvingsjaar", "InPACohortDefinitie"))


def enrich_classification(spark, d):
    lk = V.lookups(spark, d, with_local_names=False)
    e = E.add_isced(_enrolment(spark, d), lk.dec_ho_isced)
    return norm(e.select(PGN, "Inschrijvingsjaar", "ISCEDF2013Detailgroep", "ISCEDF2013DetailgroepOmschrijving",
                         "ISCEDF2013Rubriek", "ISCEDF2013RubriekOmschrijving"))


ENRICHED_COLUMNS = [
    PGN, "Inschrijvingsjaar", "Aantal", "HoogsteVooropleidingCode", "HoogsteVooropleidingVolledig",
    "HoogsteVooropleidingProfiel", "Vooropleiding", "NaamInstellingHoogsteVooropleiding", "NaamOpleidingCroho",
    "opleiding", "CrohoOnderdeel", "SoortDiploma", "HoDiplomaInEersteJaar", "TypeOpleiding", "CodeOpleiding",
    "NaamFaculteit", "InPACohortDefinitie", "ISCEDF2013Rubriek", "ISCEDF2013RubriekOmschrijving",
]


def enriched(spark, d) -> DataFrame:
    return E.enrich_enrolments(V.enrolment(spark, d), V.lookups(spark, d))


def enriched_enrolments(spark, d):
    return norm(enriched(spark, d).select(*ENRICHED_COLUMNS))


# ---------------------------------------------------------------------------
# Cohorts
# ---------------------------------------------------------------------------

def _cohort_base(spark, d) -> DataFrame:
    """Enrolments with the three columns the cohort's operators take from the enrichment."""
    return E.first_year_degree(E.add_pa_cohort(E.add_programme(_enrolment(spark, d))))


def intake(spark, d):
    return norm(K.intake(_cohort_base(spark, d)).select(PGN, "Inschrijvingsjaar", "ActueleInstelling", "opleiding"))


def second_year(spark, d):
    return norm(K.second_year(_cohort_base(spark, d)))


def first_award(spark, d):
    return norm(K.first_propaedeutic(_cohort_base(spark, d)))


def awards(spark, d):
    return norm(K.bachelor_awards(_cohort_base(spark, d)))


def _cohort(spark, d) -> DataFrame:
    return K.build_cohort(enriched(spark, d))


def cohort_year2(spark, d):
    e = _cohort_base(spark, d)
    c = K.attach_second_year(K.intake(e), K.second_year(e))
    return norm(c.select(PGN, "Inschrijvingsjaar", "ActueleInstelling_2ejaar", "opleiding_2ejaar",
                         "Opleidingsvorm_2ejaar", "OpleidingActueelEquivalent_2ejaar"))


def award_in_1_2_years(spark, d):
    return norm(_cohort(spark, d).select(PGN, "PropedeuseIn1Jaar", "PropedeuseIn2Jaar", "Uitval1JaarMetPropedeuse",
                                         "HerinschrijvingMetPropedeuse"))


def award_within_n_years(spark, d):
    return norm(_cohort(spark, d).select(PGN, "BachelorDiploma", "JaarTotEenDiploma",
                                         *[f"EenDiplomaBinnen{n}jaar" for n in K.WITHIN_YEARS]))


def award_same_programme(spark, d):
    return norm(_cohort(spark, d).select(PGN, "opleiding", "Diplomajaar_DitDiploma",
                                         "DatumTekeningDiploma_DitDiploma", "OpleidingActueelEquivalent_DitDiploma"))


def retention_flags(spark, d):
    return norm(_cohort(spark, d).select(PGN, "UitvalEerstejaar", "opleiding_gelijk", "HerinschrijvingInstelling",
                                         "SwitchBinnenInstelling"))


def cohort_hot_split(spark, d):
    """The cohort planned lazily, every branch from the enrichment, where a hot
    person is left to the skew split; it must equal the stored one."""
    c = K.build_cohort(enriched(spark, d), materialize=False)
    return norm(c.select(PGN, "StatusNa1Jaar", "UitvalEerstejaar", "PropedeuseIn1Jaar", "JaarTotEenDiploma",
                         "Diplomajaar_DitDiploma"))


def cohort_rows(spark, d):
    """The whole cohort row: every intake column and every indicator."""
    return norm(_cohort(spark, d))


def status_after_year1(spark, d):
    return norm(_cohort(spark, d).select(PGN, "StatusNa1Jaar"))


def cohort_full(spark, d):
    c = _cohort(spark, d)
    return norm(c.groupBy("Cohort", "CohortType", "TypeOpleiding", "StatusNa1Jaar").agg(
        F.count(F.lit(1)).alias("students"),
        F.sum("UitvalEerstejaar").alias("dropouts"),
        F.sum("PropedeuseIn1Jaar").alias("propaedeutic_1y"),
        F.sum("BachelorDiploma").alias("bachelors"),
        F.sum("EenDiplomaBinnen5jaar").alias("bachelor_5y"),
    ))


# ---------------------------------------------------------------------------
# Exam grades
# ---------------------------------------------------------------------------

def unpivot_grades(spark, d):
    ex = V.exam_subjects(spark, d)
    return norm(unpivot_non_null(ex, [PGN, "Diplomajaar", "VakCode", "VakAfkorting"], X.GRADE_COLUMNS,
                                 value_type="bigint"))


def _graded(spark, d):
    ex = X.classify(X.add_prior_education(V.exam_subjects(spark, d), V.dec_vooropl(spark, d)))
    return X.attempt_and_kind(X.melt_grades(ex))


def attempt_and_kind(spark, d):
    return norm(_graded(spark, d).select(PGN, "VakCode", "variable", "value", "Poging", "SoortExamen"))


def last_attempt(spark, d):
    return norm(X.last_attempt(_graded(spark, d)))


def exam_grades(spark, d):
    return norm(X.build_exam_grades(V.exam_subjects(spark, d), V.dec_vooropl(spark, d)))


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------

def _nation_region(spark, d):
    n, r = V.table(spark, d, "nation"), V.table(spark, d, "region")
    return norm(lookup_join(n, r, [("n_regionkey", "r_regionkey")]).select("n_nationkey", "n_name", "r_name"))


def sink_parquet(spark, d):
    root = scratch_path(spark, "export")
    src = norm(V.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"))
    status = export_tables({"klant-tabel": src, "regio": _nation_region(spark, d)}, root, "parquet")
    assert status == {"klant-tabel": "written", "regio": "written"}, status
    return spark.read.parquet(f"{root}/klant_tabel")


def sink_csv(spark, d):
    path = scratch_path(spark, "csv")
    write_csv(_nation_region(spark, d), path)
    schema = "n_nationkey BIGINT, n_name STRING, r_name STRING"
    return spark.read.option("header", True).schema(schema).csv(path)


def publish_table_view(spark, d):
    loc = scratch_path(spark, "catalog")
    db = "fixreg_check"
    publish_tables(spark, {"nation-2024": _nation_region(spark, d)}, db, location=loc)
    view = publish_view(spark, db, "nation", "nation-2024")
    return spark.table(view)


def publish_failed(spark, d):
    """A publication of which one table fails leaves the tables that were there."""
    loc, db = scratch_path(spark, "catalog"), "fixreg_check_failed"
    publish_tables(spark, {"nation-2024": _nation_region(spark, d)}, db, location=loc)
    broken = V.table(spark, d, "region").where("CASE WHEN r_regionkey >= 0 THEN raise_error('broken table') ELSE true END")
    try:
        publish_tables(spark, {"nation-2024": _nation_region(spark, d).limit(1), "region": broken}, db, location=loc, replace_database=True)
    except Exception as exc:
        if "broken table" not in str(exc):
            raise
    return spark.table(f"{db}.nation_2024")


def sink_balanced(spark, d):
    """A table by year, most rows of one year, rebalanced; then the years that changed replaced alone."""
    path = scratch_path(spark, "balanced")
    orders = V.table(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 3 <> 0 THEN 1995 ELSE year(o_orderdate) END AS jaar", "o_totalprice AS bedrag")
    write_parquet(orders, path, partition_by=["jaar"], balanced=True, max_rows_per_file=100_000)
    changed = orders.where("jaar IN (1996, 1997)").withColumn("bedrag", F.lit(0.5))
    write_parquet(changed, path, partition_by=["jaar"], balanced=True, changed_only=True)
    return norm(spark.read.parquet(path))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fwf_roundtrip_customer": fwf_roundtrip_customer,
    "fwf_untyped": fwf_untyped,
    "fwf_unknown_converter": fwf_unknown_converter,
    "fwf_bad_values": fwf_bad_values,
    "fwf_declared_offsets": fwf_declared_offsets,
    "fwf_na_values": fwf_na_values,
    "fwf_garbage_rows": fwf_garbage_rows,
    "garbage_examples": garbage_examples,
    "fwf_garbage_keep": fwf_garbage_keep,
    "fwf_quarantine": fwf_quarantine,
    "fwf_dates_zero_null": fwf_dates_zero_null,
    "fwf_float": fwf_float,
    "conv_null": conv_null,
    "recode_two_codes": recode_two_codes,
    "recode_int_codes": recode_int_codes,
    "custom_converter": custom_converter,
    "fwf_by_kind": fwf_by_kind,
    "feed_report": feed_report_query,
    "delimited_lookup": delimited_lookup,
    "stream_roundtrip_customer": stream_roundtrip_customer,
    "crosswalk_permute": crosswalk_permute,
    "pseudonymise_two_tables": pseudonymise_two_tables,
    "pseudonymise_hash": pseudonymise_hash,
    "add_local_id": add_local_id_query,
    "lookup_join_checked": lookup_join_checked,
    "lookup_join_null_keys": lookup_join_null_keys,
    "member_flag": member_flag_query,
    "anti_join": anti_join_query,
    "duplicate_key_report": duplicate_key_report,
    "key_profile": key_profile,
    "classify_text": classify_text,
    "map_profile": map_profile,
    "enrich_by_code": enrich_by_code,
    "two_key_lookup": two_key_lookup,
    "coalesce_code": coalesce_code,
    "recode_default_unknown": recode_default_unknown,
    "recode_keep_unmapped": recode_keep_unmapped,
    "first_year_award_flag": first_year_award_flag,
    "local_names_unmatched": local_names_unmatched,
    "local_names_join": local_names_join,
    "seven_predicate_cohort": seven_predicate_cohort,
    "enrich_classification": enrich_classification,
    "enriched_enrolments": enriched_enrolments,
    "intake": intake,
    "second_year": second_year,
    "first_award": first_award,
    "awards": awards,
    "cohort_year2": cohort_year2,
    "award_in_1_2_years": award_in_1_2_years,
    "award_within_n_years": award_within_n_years,
    "award_same_programme": award_same_programme,
    "retention_flags": retention_flags,
    "status_after_year1": status_after_year1,
    "cohort_hot_split": cohort_hot_split,
    "cohort_full": cohort_full,
    "cohort_rows": cohort_rows,
    "delimited_file": delimited_file,
    "fwf_garbage_far": fwf_garbage_far,
    "converted_years": converted_years,
    "unpivot_grades": unpivot_grades,
    "attempt_and_kind": attempt_and_kind,
    "last_attempt": last_attempt,
    "exam_grades": exam_grades,
    "sink_parquet": sink_parquet,
    "sink_csv": sink_csv,
    "publish_table_view": publish_table_view,
    "convert_quarantine": convert_quarantine,
    "conversion_accounts": conversion_accounts,
    "convert_local_ids": convert_local_ids,
    "dated_layouts": dated_layouts,
    "converted_types": converted_types,
    "column_profile": column_profile,
    "assets_unmatched_report": assets_unmatched_report,
    "publish_failed": publish_failed,
    "sink_balanced": sink_balanced,
    "two_key_lookup_kinds": two_key_lookup_kinds,
}
