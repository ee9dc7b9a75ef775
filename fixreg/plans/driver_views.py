"""Register-shaped views over the check tables (orders, customer, part, …).

The operators are checked on the shared test tables.  These views map
those tables onto the register's column names with simple, documented
rules.  Each rule is one SQL expression, used by Spark (``selectExpr``) and
by the DuckDB oracle alike, so both sides start from identical input and
only the operator under test differs.

Base view ENR (every order): person = ``o_custkey``, year =
``year(o_orderdate)``; all but the person's first order of a year (by date,
then order key) are side enrolments; ``first_yr`` = the person's first year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixreg.plans.enrich import Lookups
from fixreg.sources.delimited import parse_delimited
from fixreg.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# Programme digit of an order: the leading digit of its priority (1..5).
PRIO = "CAST(substr(o_orderpriority, 1, 1) AS BIGINT)"
PROGRAMME_CODE = (
    f"CAST(CASE {PRIO} WHEN 1 THEN 34560 WHEN 2 THEN 34561 WHEN 3 THEN 80012 WHEN 4 THEN 8012 "
    "ELSE 39120 END AS BIGINT)"
)

# Test vocabulary for prior-education descriptions: one phrase per
# classifier rule plus phrases that must not match (whole-word rule).
PHRASES = [
    "MBO niveau 4",
    "vwo profiel NT",
    "havo profiel CM",
    "hbo-p propedeuse",
    "hbo-ba bachelor",
    "hbo-ad associate",
    "hbo-vo/ma master",
    "hbo-pim",
    "wo-p propedeuse",
    "WO-BA bachelor",
    "wo-on/ma master",
    "wo-pim",
    "wo-vo/ma/bf",
    "HAVO/VWO",
    "mbov",
    "buitenlands diploma",
]


def phrase_expr(key_sql: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES))
    return f"CASE CAST(({key_sql}) % {len(PHRASES)} AS BIGINT) {whens} END"


PRIOR_CODE_OF_PART = (
    "CASE WHEN p_partkey % 2 = 0 THEN '002' ELSE '004' END || lpad(CAST(p_partkey % 13 AS STRING), 2, '0')"
)

# Enrolment columns over ENR (columns of orders + yr + first_yr).
ENROLMENT_EXPRS = [
    ("PersoonsgebondenNummer", "lpad(CAST(o_custkey AS STRING), 12, '0')"),
    ("Inschrijvingsjaar", "yr"),
    ("EersteJaarAanDezeActueleInstelling", "first_yr"),
    ("EersteJaarInHetHogerOnderwijs", "CASE WHEN o_custkey % 4 = 0 THEN first_yr - 1 ELSE first_yr END"),
    ("IndicatieActiefOpPeildatum", "CAST(CASE WHEN o_orderkey % 10 = 9 THEN 0 ELSE 1 END AS BIGINT)"),
    ("SoortInschrijvingHogerOnderwijs", "CASE WHEN side OR o_orderkey % 7 = 6 THEN '2' ELSE '1' END"),
    ("ActueleInstelling", "'21X' || CAST(o_orderkey % 3 AS STRING)"),
    ("Opleidingscode", PROGRAMME_CODE),
    ("OpleidingActueelEquivalent", f"lpad(CAST({PROGRAMME_CODE} AS STRING), 5, '0')"),
    ("OpleidingHistorischEquivalent", f"CASE WHEN {PRIO} = 2 THEN '34560' END"),
    ("Opleidingsvorm", "CASE WHEN o_orderkey % 4 = 3 THEN 'deeltijd' ELSE 'voltijd' END"),
    ("Opleidingsfase", f"CASE {PRIO} WHEN 1 THEN 'B' WHEN 2 THEN 'B' WHEN 3 THEN 'A' WHEN 4 THEN 'M' "
                       "ELSE CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'X' END END"),
    ("TypeHogerOnderwijsBinnenSoortHogerOnderwijs",
     f"CASE {PRIO} WHEN 1 THEN 'ba' WHEN 2 THEN 'ba' WHEN 3 THEN 'ad' WHEN 4 THEN 'ma' ELSE 'pm' END"),
    ("CrohoOnderdeelActueleOpleiding", "CASE WHEN o_custkey % 11 = 10 THEN NULL ELSE CAST(o_custkey % 11 AS STRING) END"),
    ("Diplomajaar", "CASE WHEN o_orderstatus = 'F' THEN yr END"),
    ("OpleidingsfaseActueelVanHetDiploma",
     "CASE WHEN o_orderstatus = 'F' THEN CASE o_orderkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'B' ELSE 'Q' END END"),
    ("SoortDiplomaSoortHogerOnderwijs", "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 12 AS BIGINT) END"),
    ("DatumTekeningDiploma", "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END"),
    ("HoogsteVooropleiding",
     "CASE WHEN o_custkey % 5 = 0 THEN '002' ELSE '004' END || lpad(CAST(o_custkey % 13 AS STRING), 2, '0')"),
    ("HoogsteVooropleidingVoorHetHo",
     "CASE WHEN o_custkey % 6 = 0 THEN '00301' ELSE CASE WHEN o_custkey % 5 = 0 THEN '002' ELSE '004' END "
     "|| lpad(CAST(o_custkey % 13 AS STRING), 2, '0') END"),
    ("InstellingVanDeHoogsteVooropleiding", "lpad(CAST(o_custkey % 150 AS STRING), 4, '0')"),
    ("VestigingsnummerVanDeHoogsteVooropleiding", "lpad(CAST(o_custkey % 3 AS STRING), 2, '0')"),
]

# Lookups.  Each groups a scanned table down to one row per code.
DEC_VOPL_SQL = (
    f"SELECT {PRIOR_CODE_OF_PART} AS VooropleidingCode, "
    f"max({phrase_expr('p_partkey % 13 + 2 * (p_partkey % 2)')}) AS OmschrijvingVooropleiding "
    "FROM part GROUP BY 1"
)
DEC_ISAT_SQL = (
    f"SELECT lpad(CAST({PROGRAMME_CODE} AS STRING), 5, '0') AS Opleidingscode, "
    "max('Opleiding ' || o_orderpriority) AS NaamOpleiding FROM orders GROUP BY 1"
)
DEC_ISCED_SQL = (
    f"SELECT {PROGRAMME_CODE} AS Opleidingscode, "
    f"max(lpad(CAST({PRIO} * 111 AS STRING), 4, '0')) AS ISCEDF2013Detailgroep, "
    f"max('Detailgroep ' || CAST({PRIO} AS STRING)) AS ISCEDF2013DetailgroepOmschrijving, "
    f"max('0' || CAST({PRIO} * 100 + 13 AS STRING)) AS ISCEDF2013Rubriek, "
    f"max('Rubriek ' || CAST({PRIO} AS STRING)) AS ISCEDF2013RubriekOmschrijving "
    "FROM orders GROUP BY 1"
)
REGISTER_EXPRS = [
    ("Brinnummer", "lpad(CAST(s_suppkey AS STRING), 4, '0')"),
    ("Vestigingsnummer", "lpad(CAST(s_nationkey % 3 AS STRING), 2, '0')"),
    ("NaamInstellingVooropleiding", "s_name"),
    ("PostcodeInstellingVooropleiding", "lpad(CAST(s_nationkey AS STRING), 4, '0')"),
    ("PlaatsInstellingVooropleiding", "'Plaats ' || CAST(s_nationkey AS STRING)"),
    ("DatumOprichtingInstellingVooropleiding", "CAST('1990-01-01' AS DATE)"),
    ("DatumOpheffingInstellingVooropleiding", "CAST(NULL AS DATE)"),
    ("DenominatieInstellingVooropleidingCode", "CAST(s_nationkey % 5 AS STRING)"),
    ("NaamDenominatieInstellingVooropleiding", "'Denominatie ' || CAST(s_nationkey % 5 AS STRING)"),
]
# Local names exist for three of the five programmes (E11 reports the rest).
LOCAL_NAME_LINE = (
    f"concat_ws(';', lpad(CAST({PROGRAMME_CODE} AS STRING), 5, '0'), 'C' || CAST({PRIO} AS STRING), "
    f"'Lokale naam ' || CAST({PRIO} AS STRING), 'Faculteit ' || CAST({PRIO} % 2 AS STRING), "
    f"'F' || CAST({PRIO} % 2 AS STRING))"
)
LOCAL_NAME_FILTER = f"{PRIO} IN (1, 2, 4)"
LOCAL_NAME_COLUMNS = ["Opleidingscode", "CodeOpleiding", "NaamOpleiding", "NaamFaculteit", "CodeFaculteit"]

# Exam subjects over lineitem: person = order, grades 1..9, 0 → missing.
EXAM_EXPRS = [
    ("PersoonsgebondenNummer", "lpad(CAST(l_orderkey AS STRING), 12, '0')"),
    ("VooropleidingOorspronkelijkeCode", "lpad(CAST(l_suppkey % 20 AS STRING), 5, '0')"),
    ("Diplomajaar", "CAST(year(l_shipdate) AS BIGINT)"),
    ("VakCode", "lpad(CAST(l_partkey % 50 AS STRING), 4, '0')"),
    ("VakAfkorting", "l_returnflag || l_linestatus"),
    ("CijferEersteCentraalExamen", "NULLIF(CAST(floor(l_quantity) AS BIGINT) % 10, 0)"),
    ("CijferTweedeCentraalExamen",
     "CASE WHEN l_linenumber >= 3 THEN NULLIF(CAST(floor(l_discount * 100) AS BIGINT) % 10, 0) END"),
    ("CijferDerdeCentraalExamen",
     "CASE WHEN l_linenumber >= 5 THEN NULLIF(CAST(floor(l_tax * 100) AS BIGINT) % 10, 0) END"),
    ("CijferSchoolexamen", "NULLIF(CAST(floor(l_extendedprice) AS BIGINT) % 10, 0)"),
]
DEC_VOOROPL_SQL = (
    "SELECT lpad(CAST(s_suppkey % 20 AS STRING), 5, '0') AS VooropleidingOorspronkelijkeCode, "
    "max(CASE WHEN s_suppkey % 20 < 10 THEN 'HAVO' ELSE 'VWO' END) AS Onderwijssector, "
    f"max({phrase_expr('s_suppkey % 20')}) AS OmschrijvingVooropleidingOorspronkelijkeCode "
    "FROM supplier GROUP BY 1"
)


def _select(df: DataFrame, exprs: list[tuple[str, str]]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in exprs])


def enr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENR: every order, with the person's first year and whether it is a side
    enrolment (not the person's first order of the year).  Both come from
    aggregates by person and year, joined back."""
    o = table(spark, sf_dir, "orders").withColumn("yr", F.year("o_orderdate").cast("bigint"))
    first = o.groupBy("o_custkey", "yr").agg(F.min(F.struct("o_orderdate", "o_orderkey")).alias("first"))
    start = first.groupBy("o_custkey").agg(F.min("yr").alias("first_yr"))
    return (o.join(first, ["o_custkey", "yr"]).join(start, "o_custkey")
            .withColumn("side", F.col("o_orderkey") != F.col("first.o_orderkey")).drop("first"))


def enrolment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(enr(spark, sf_dir), ENROLMENT_EXPRS)


def lookups(spark: SparkSession, sf_dir: str, with_local_names: bool = True) -> Lookups:
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    supplier = table(spark, sf_dir, "supplier")
    code = F.expr(PRIOR_CODE_OF_PART)
    dec_vopl = part.groupBy(code.alias("VooropleidingCode")).agg(
        F.max(F.expr(phrase_expr("p_partkey % 13 + 2 * (p_partkey % 2)"))).alias("OmschrijvingVooropleiding"))
    prog = F.expr(f"lpad(CAST({PROGRAMME_CODE} AS STRING), 5, '0')")
    dec_isat = orders.groupBy(prog.alias("Opleidingscode")).agg(
        F.max(F.expr("'Opleiding ' || o_orderpriority")).alias("NaamOpleiding"))
    prio = F.expr(PRIO)
    dec_isced = orders.groupBy(F.expr(PROGRAMME_CODE).alias("Opleidingscode")).agg(
        F.max(F.lpad((prio * 111).cast("string"), 4, "0")).alias("ISCEDF2013Detailgroep"),
        F.max(F.concat(F.lit("Detailgroep "), prio.cast("string"))).alias("ISCEDF2013DetailgroepOmschrijving"),
        F.max(F.concat(F.lit("0"), (prio * 100 + 13).cast("string"))).alias("ISCEDF2013Rubriek"),
        F.max(F.concat(F.lit("Rubriek "), prio.cast("string"))).alias("ISCEDF2013RubriekOmschrijving"),
    )
    register = _select(supplier, REGISTER_EXPRS)
    local = local_names(spark, sf_dir) if with_local_names else None
    return Lookups(dec_vopl, register, dec_isat, dec_isced, local)


def local_name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``;``-separated local-name lines, one per programme that has one."""
    o = table(spark, sf_dir, "orders").filter(F.expr(LOCAL_NAME_FILTER))
    return o.select(F.expr(LOCAL_NAME_LINE).alias("line")).distinct()


def local_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_delimited(local_name_lines(spark, sf_dir), "line", LOCAL_NAME_COLUMNS)


def exam_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), EXAM_EXPRS)


def dec_vooropl(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.groupBy(F.expr("lpad(CAST(s_suppkey % 20 AS STRING), 5, '0')").alias(
        "VooropleidingOorspronkelijkeCode")).agg(
        F.max(F.expr("CASE WHEN s_suppkey % 20 < 10 THEN 'HAVO' ELSE 'VWO' END")).alias("Onderwijssector"),
        F.max(F.expr(phrase_expr("s_suppkey % 20"))).alias("OmschrijvingVooropleidingOorspronkelijkeCode"),
    )


# ---------------------------------------------------------------------------
# SQL text of the same views, for the oracle (DuckDB dialect).
# ---------------------------------------------------------------------------

ENR_SQL = (
    "o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS yr FROM orders), "
    "f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, yr ORDER BY o_orderdate, o_orderkey) > 1 AS side FROM o), "
    "enr AS (SELECT f.*, min(yr) OVER (PARTITION BY o_custkey) AS first_yr FROM f)"
)


def select_sql(exprs: list[tuple[str, str]], source: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs) + f" FROM {source}"


def enrolment_ctes() -> str:
    return ENR_SQL + f", ev AS ({select_sql(ENROLMENT_EXPRS, 'enr')})"


def lookup_ctes() -> str:
    local = (f"SELECT DISTINCT lpad(CAST({PROGRAMME_CODE} AS STRING), 5, '0') AS Opleidingscode, "
             f"'C' || CAST({PRIO} AS STRING) AS CodeOpleiding, 'Lokale naam ' || CAST({PRIO} AS STRING) AS NaamOpleiding, "
             f"'Faculteit ' || CAST({PRIO} % 2 AS STRING) AS NaamFaculteit, 'F' || CAST({PRIO} % 2 AS STRING) AS CodeFaculteit "
             f"FROM orders WHERE {LOCAL_NAME_FILTER}")
    return (
        f"vopl AS ({DEC_VOPL_SQL}), isat AS ({DEC_ISAT_SQL}), isced AS ({DEC_ISCED_SQL}), "
        f"brin AS ({select_sql(REGISTER_EXPRS, 'supplier')}), lokaal AS ({local})"
    )
