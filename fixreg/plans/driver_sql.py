"""Oracle SQL (DuckDB dialect) for the check queries in ``driver_queries``.

Written from the operator semantics, not from the Spark code: the same
input views (``driver_views``), then plain SQL for what each operator
should produce.
"""

from __future__ import annotations

from fixreg.plans import driver_views as V

SALT = "fixreg-check-salt"

# Fixed values, written out from the register's code lists (not taken from the
# implementation, so that a wrong code there shows).
PRIOR_EDUCATION_RULES = [("mbo", "mbo"), ("vwo", "vwo"), ("havo", "havo"), ("hbo-p", "hbo-p"), ("hbo-ba", "hbo-ba"), ("hbo-ad", "hbo-ad"),
                         ("hbo-vo/ma", "hbo-master"), ("hbo-pim", "hbo-master"), ("wo-p", "wo-p"), ("wo-ba", "wo-ba"),
                         ("wo-on/ma", "wo-master"), ("wo-pim", "wo-master"), ("wo-vo/ma/bf", "wo-master")]
PROFILE_BY_CODE = {
    "00200": "ONB", "00201": "ALG", "00202": "CM", "00203": "EM", "00204": "EM & CM", "00205": "NG", "00206": "NG & CM",
    "00207": "NG & EM", "00208": "NT", "00209": "NT & CM", "00210": "NT & EM", "00211": "NT & NG",
    "00400": "ONG", "00401": "ALG", "00402": "CM", "00403": "EM", "00404": "EM & CM", "00405": "NG", "00406": "NG & CM",
    "00407": "NG & EM", "00408": "NT", "00409": "NT & CM", "00410": "NT & EM", "00411": "NT & NG",
}
SECTORS = {
    "0": "sectoroverstijgend", "1": "onderwijs", "2": "landbouw en natuurlijke omgeving", "3": "natuur", "4": "techniek",
    "5": "gezondheidszorg", "6": "economie", "7": "recht", "8": "gedrag en maatschappij", "9": "taal en cultuur",
}
DKINDS = {"D": "propedeuse", "A": "associate degree", "B": "bachelor", "M": "master", "Q": "post-initiele master"}
PTYPES = {
    "O": "oude stijl (toegestaan t/m studiejaar 1992-1993)", "P": "propedeuse",
    "1": "1e fase (WO); hoofdfase (HBO) (toegestaan t/m studiejaar 92-93)", "2": "2e fase (toegestaan t/m studiejaar 1996-1997)",
    "I": "initiële opleiding (toegestaan vanaf studiejaar 1993-1994)", "V": "vervolgopleiding (toegestaan vanaf studiejaar 1993-1994)",
    "K": "kandidaatsfase", "D": "propedeuse bachelor", "B": "bachelor", "M": "master", "A": "associate degree",
    "T": "tussentijds doctoraal", "Q": "post-initiële master",
}
BOUNDARY = "\\b"  # regex word boundary


def _case_map(col: str, mapping: dict, default_sql: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {default_sql} END"


def _classify(col: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower({col}), '{BOUNDARY}{w}{BOUNDARY}') THEN '{lab}'" for w, lab in PRIOR_EDUCATION_RULES
    )
    return f"CASE {whens} ELSE 'overig' END"


def _zpad(expr: str, n: int) -> str:
    return f"CASE WHEN length({expr}) < {n} THEN lpad({expr}, {n}, '0') ELSE {expr} END"


def _flag(pred: str) -> str:
    return f"CAST(CASE WHEN coalesce({pred}, false) THEN 1 ELSE 0 END AS BIGINT)"


def _cell(expr: str) -> str:
    return f"NULLIF(trim({expr}), '')"


SQL: dict[str, str] = {}

# --- fixed-width ------------------------------------------------------------
CUST = (f"SELECT CAST(c_custkey AS BIGINT) AS c_custkey, {_cell('substr(c_name, 1, 25)')} AS c_name, "
        f"CAST(c_nationkey AS BIGINT) AS c_nationkey, {_cell('substr(c_mktsegment, 1, 10)')} AS c_mktsegment FROM customer")
SQL["fwf_roundtrip_customer"] = CUST
SQL["stream_roundtrip_customer"] = CUST
SQL["fwf_untyped"] = (
    f"SELECT lpad(CAST(c_custkey AS STRING), 10, '0') AS c_custkey, {_cell('substr(c_name, 1, 25)')} AS c_name, "
    f"CAST(c_nationkey AS STRING) AS c_nationkey, {_cell('substr(c_mktsegment, 1, 10)')} AS c_mktsegment FROM customer")
SQL["fwf_unknown_converter"] = (
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, CAST(c_nationkey AS STRING) AS c_nationkey FROM customer")
SQL["fwf_bad_values"] = (
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, "
    "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS c_nationkey FROM customer")
SQL["fwf_declared_offsets"] = (
    f"SELECT CAST(c_custkey AS BIGINT) AS c_custkey, {_cell('substr(c_name, 1, 25)')} AS c_name, "
    "CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
SQL["fwf_na_values"] = (
    "SELECT lpad(CAST(c_custkey AS STRING), 10, '0') AS c_custkey, "
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS c_nationkey, "
    f"CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE {_cell('substr(c_mktsegment, 1, 10)')} END AS c_mktsegment "
    "FROM customer")
GARBAGE = ("SELECT CAST(p_partkey AS BIGINT) AS p_partkey, 'XTRA' || CAST(p_size AS STRING) AS GarbageColumn "
           "FROM part WHERE p_type = 'PROMO'")
SQL["fwf_garbage_rows"] = GARBAGE
SQL["garbage_examples"] = GARBAGE + " ORDER BY p_partkey LIMIT 10"
SQL["fwf_garbage_keep"] = (
    "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, NULLIF(trim(p_brand), '') AS p_brand, "
    "CASE WHEN p_type = 'PROMO' THEN 'XTRA' || CAST(p_size AS STRING) END AS GarbageColumn FROM part")
SQL["fwf_quarantine"] = (
    "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, NULLIF(trim(p_brand), '') AS p_brand FROM part "
    "WHERE p_type <> 'PROMO' OR p_type IS NULL")
SQL["fwf_dates_zero_null"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, "
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate, "
    "CAST(NULLIF(o_orderkey % 100, 0) AS BIGINT) AS code FROM orders")
SQL["fwf_float"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "l_extendedprice FROM lineitem")
SQL["conv_null"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "CAST(NULL AS STRING) AS l_comment FROM lineitem")
SQL["recode_two_codes"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "CASE l_returnflag WHEN 'A' THEN 'man' WHEN 'R' THEN 'vrouw' ELSE 'onbekend' END AS Geslacht FROM lineitem")
SQL["recode_int_codes"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "CASE WHEN l_linestatus = 'O' AND l_linenumber = 7 THEN NULL WHEN l_linenumber = 1 THEN 'voltijd' "
    "WHEN l_linenumber = 2 THEN 'deeltijd' WHEN l_linenumber = 3 THEN 'duaal' "
    "ELSE CAST(l_linenumber AS STRING) END AS Opleidingsvorm FROM lineitem")
SQL["custom_converter"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, "
    "CAST(floor(o_totalprice * 100) AS BIGINT) / 100.0 AS amount FROM orders")
SQL["fwf_by_kind"] = (
    "SELECT 'Dec_klant' AS layout, CAST(c_custkey AS BIGINT) AS c_custkey, replace(c_name, 'Customer', 'Cliënt') AS c_name, "
    f"CAST(c_nationkey AS BIGINT) AS c_nationkey, {_cell('substr(c_mktsegment, 1, 10)')} AS c_mktsegment, CAST(NULL AS BIGINT) AS o_orderkey, "
    "CAST(NULL AS BIGINT) AS o_custkey, NULL AS o_orderstatus, CAST(NULL AS DATE) AS o_orderdate, NULL AS o_orderpriority FROM customer "
    "UNION ALL SELECT 'EVorders', NULL, NULL, NULL, NULL, CAST(o_orderkey AS BIGINT), CAST(o_custkey AS BIGINT), o_orderstatus, "
    f"CAST(o_orderdate AS DATE), {_cell('substr(o_orderpriority, 1, 15)')} FROM orders")
SQL["delimited_file"] = (
    "SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS NationCode, n_name || ' é' AS NationName, "
    "CAST(n_regionkey AS STRING) AS RegionCode FROM nation")
SQL["fwf_garbage_far"] = "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, 'ver ' || CAST(p_size AS STRING) AS GarbageColumn FROM part WHERE p_size > 40"
SQL["converted_years"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, "
    "CASE WHEN year(o_orderdate) % 2 = 1 THEN CAST(o_custkey AS BIGINT) END AS o_custkey FROM orders")
SQL["feed_report"] = (
    "SELECT 'EV21XX_orders.asc' AS entry, 'EVorders' AS layout, count(*) AS records, CAST(0 AS BIGINT) AS garbage_records "
    "FROM orders UNION ALL SELECT 'dec_KLANT.asc', 'Dec_klant', count(*), 0 FROM customer "
    "UNION ALL SELECT 'notes.txt', '❌', count(*), 0 FROM region "
    "UNION ALL SELECT '❌', 'VAKHAVW_leeg', NULL, NULL")
SQL["delimited_lookup"] = (
    "SELECT lpad(CAST(n_nationkey AS STRING), 3, '0') AS NationCode, n_name AS NationName, "
    "CAST(n_regionkey AS STRING) AS RegionCode FROM nation")

# --- privacy -----------------------------------------------------------------
XWALK = (
    "ids AS (SELECT DISTINCT lpad(CAST(c_custkey AS STRING), 12, '0') AS id FROM "
    "(SELECT c_custkey FROM customer UNION ALL SELECT o_custkey FROM orders)), "
    "a AS (SELECT id, row_number() OVER (ORDER BY id) AS r FROM ids), "
    f"b AS (SELECT id, row_number() OVER (ORDER BY sha256('{SALT}' || id), id) AS r FROM ids), "
    f"xw AS (SELECT a.id AS id, {_zpad('b.id', 7)} AS pseudo FROM a JOIN b USING (r))"
)
SQL["crosswalk_permute"] = (
    "WITH " + XWALK.replace("(SELECT c_custkey FROM customer UNION ALL SELECT o_custkey FROM orders)", "customer")
    + " SELECT id AS PersoonsgebondenNummer, pseudo AS PersoonsgebondenNummer_new FROM xw")
SQL["pseudonymise_two_tables"] = (
    "WITH " + XWALK + ", "
    "op AS (SELECT o_orderkey, xw.pseudo AS pgn FROM orders LEFT JOIN xw ON lpad(CAST(o_custkey AS STRING), 12, '0') = xw.id), "
    "cp AS (SELECT xw.pseudo AS pgn, c_nationkey FROM customer LEFT JOIN xw ON lpad(CAST(c_custkey AS STRING), 12, '0') = xw.id) "
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, op.pgn AS PersoonsgebondenNummer, "
    "CAST(cp.c_nationkey AS BIGINT) AS c_nationkey, CAST(NULL AS STRING) AS Onderwijsnummer, "
    "CAST(NULL AS STRING) AS Burgerservicenummer FROM op LEFT JOIN cp ON op.pgn = cp.pgn")
SQL["pseudonymise_hash"] = (
    f"SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, sha256('{SALT}' || lpad(CAST(o_custkey AS STRING), 12, '0')) "
    "AS PersoonsgebondenNummer, CAST(NULL AS STRING) AS Onderwijsnummer FROM orders")
SQL["add_local_id"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, lpad(CAST(o_custkey AS STRING), 12, '0') AS PersoonsgebondenNummer, "
    "'S' || CAST(c_custkey AS STRING) AS studentnummer FROM orders LEFT JOIN customer ON o_custkey = c_custkey")

# --- joins -----------------------------------------------------------------
SQL["lookup_join_checked"] = (
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, n_name, r_name FROM customer "
    "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
SQL["lookup_join_null_keys"] = (
    "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer), "
    "n AS (SELECT CASE WHEN n_nationkey = 24 THEN NULL ELSE n_nationkey END AS k, n_name FROM nation) "
    "SELECT CAST(c.c_custkey AS BIGINT) AS c_custkey, CAST(c.k AS BIGINT) AS k, n.n_name FROM c "
    "LEFT JOIN n ON c.k IS NOT DISTINCT FROM n.k")
FIRST_YEAR_AWARD = (
    "fy AS (SELECT o_custkey, min(year(o_orderdate)) AS first_yr FROM orders GROUP BY o_custkey), "
    "aw AS (SELECT o.o_custkey FROM orders o JOIN fy USING (o_custkey) "
    "WHERE o.o_orderstatus = 'F' AND year(o.o_orderdate) = fy.first_yr)")
SQL["member_flag"] = (
    f"WITH {FIRST_YEAR_AWARD} SELECT CAST(c_custkey AS BIGINT) AS c_custkey, "
    "CAST(CASE WHEN EXISTS (SELECT 1 FROM aw WHERE aw.o_custkey = c_custkey) THEN 1 ELSE 0 END AS BIGINT) "
    "AS award_in_first_year FROM customer")
SQL["anti_join"] = (
    f"WITH {FIRST_YEAR_AWARD} SELECT CAST(c_custkey AS BIGINT) AS c_custkey FROM customer "
    "WHERE NOT EXISTS (SELECT 1 FROM aw WHERE aw.o_custkey = c_custkey)")
SQL["duplicate_key_report"] = (
    "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
SQL["key_profile"] = (
    "SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, count(*) FILTER (WHERE l_suppkey IS NULL) "
    "AS n_null, count(l_suppkey) AS n_not_null, CAST(max(l_orderkey) AS BIGINT) AS max_key FROM lineitem")

# --- enrichment ------------------------------------------------------------
PART_TEXT = V.phrase_expr("p_partkey") + " || ' ' || p_name"
SQL["classify_text"] = (
    f"SELECT CAST(p_partkey AS BIGINT) AS p_partkey, "
    f"{_classify(PART_TEXT)} AS Vooropleiding FROM part")
SQL["map_profile"] = (
    f"WITH p AS (SELECT p_partkey, {V.PRIOR_CODE_OF_PART} AS code FROM part) "
    f"SELECT CAST(p_partkey AS BIGINT) AS p_partkey, code, {_case_map('code', PROFILE_BY_CODE, 'NULL')} AS Profiel FROM p")

EV = V.enrolment_ctes()
LK = V.lookup_ctes()
VOPL = (f"vopl2 AS (SELECT VooropleidingCode, OmschrijvingVooropleiding, "
        f"{_case_map('VooropleidingCode', PROFILE_BY_CODE, 'NULL')} AS ProfielVooropleiding, "
        f"{_classify('OmschrijvingVooropleiding')} AS Vooropleiding FROM vopl)")
SQL["enrich_by_code"] = (
    f"WITH {EV}, {LK}, {VOPL} SELECT ev.PersoonsgebondenNummer, ev.Inschrijvingsjaar, "
    "v.VooropleidingCode AS HoogsteVooropleidingCode, v.OmschrijvingVooropleiding AS HoogsteVooropleidingVolledig, "
    "v.ProfielVooropleiding AS HoogsteVooropleidingProfiel, v.Vooropleiding, i.NaamOpleiding AS NaamOpleidingCroho "
    "FROM ev LEFT JOIN vopl2 v ON ev.HoogsteVooropleiding IS NOT DISTINCT FROM v.VooropleidingCode "
    "LEFT JOIN isat i ON ev.OpleidingActueelEquivalent IS NOT DISTINCT FROM i.Opleidingscode")
SQL["two_key_lookup"] = (
    f"WITH {EV}, {LK} SELECT ev.PersoonsgebondenNummer, ev.Inschrijvingsjaar, ev.InstellingVanDeHoogsteVooropleiding, "
    "ev.VestigingsnummerVanDeHoogsteVooropleiding, b.NaamInstellingVooropleiding AS NaamInstellingHoogsteVooropleiding, "
    "b.PlaatsInstellingVooropleiding AS PlaatsInstellingHoogsteVooropleiding, "
    "b.DatumOprichtingInstellingVooropleiding AS DatumOprichtingInstellingHoogsteVooropleiding FROM ev "
    "LEFT JOIN brin b ON ev.InstellingVanDeHoogsteVooropleiding IS NOT DISTINCT FROM b.Brinnummer "
    "AND ev.VestigingsnummerVanDeHoogsteVooropleiding IS NOT DISTINCT FROM b.Vestigingsnummer")
SQL["coalesce_code"] = (
    f"WITH {EV} SELECT PersoonsgebondenNummer, Inschrijvingsjaar, "
    "coalesce(OpleidingHistorischEquivalent, OpleidingActueelEquivalent) AS opleiding FROM ev")

SQL["recode_default_unknown"] = (
    f"WITH {EV} SELECT PersoonsgebondenNummer, Inschrijvingsjaar, "
    f"coalesce({_case_map('CrohoOnderdeelActueleOpleiding', SECTORS, 'CrohoOnderdeelActueleOpleiding')}, 'onbekend') "
    f"AS CrohoOnderdeel, coalesce({_case_map('Opleidingsfase', PTYPES, 'Opleidingsfase')}, 'onbekend') AS TypeOpleiding "
    "FROM ev")
SQL["recode_keep_unmapped"] = (
    f"WITH {EV} SELECT PersoonsgebondenNummer, Inschrijvingsjaar, "
    f"{_case_map('OpleidingsfaseActueelVanHetDiploma', DKINDS, 'OpleidingsfaseActueelVanHetDiploma')} AS SoortDiploma "
    "FROM ev")
E9 = _flag("SoortDiplomaSoortHogerOnderwijs BETWEEN 3 AND 10 AND Diplomajaar = EersteJaarAanDezeActueleInstelling")
SQL["first_year_award_flag"] = (
    f"WITH {EV} SELECT PersoonsgebondenNummer, Inschrijvingsjaar, {E9} AS HoDiplomaInEersteJaar FROM ev")
SQL["local_names_unmatched"] = (
    f"WITH {EV}, {LK} SELECT DISTINCT ev.OpleidingActueelEquivalent, i.NaamOpleiding AS NaamOpleidingCroho FROM ev "
    "LEFT JOIN isat i ON ev.OpleidingActueelEquivalent = i.Opleidingscode "
    "WHERE NOT EXISTS (SELECT 1 FROM lokaal l WHERE l.Opleidingscode IS NOT DISTINCT FROM ev.OpleidingActueelEquivalent)")
SQL["local_names_join"] = (
    f"WITH {EV}, {LK} SELECT ev.PersoonsgebondenNummer, ev.Inschrijvingsjaar, l.CodeOpleiding, l.NaamOpleiding, "
    "l.NaamFaculteit, l.CodeFaculteit FROM ev LEFT JOIN lokaal l "
    "ON ev.OpleidingActueelEquivalent IS NOT DISTINCT FROM l.Opleidingscode")
CODE5 = _zpad("CAST(Opleidingscode AS STRING)", 5)
E12 = (
    "CASE WHEN coalesce(IndicatieActiefOpPeildatum = 1, false) "
    "AND coalesce(TRY_CAST(SoortInschrijvingHogerOnderwijs AS BIGINT) = 1, false) "
    "AND coalesce(TypeHogerOnderwijsBinnenSoortHogerOnderwijs = 'ba', false) "
    f"AND coalesce(NOT starts_with({CODE5}, '80'), true) "
    "AND coalesce(Opleidingsvorm = 'voltijd', false) "
    "AND coalesce(HoogsteVooropleiding = HoogsteVooropleidingVoorHetHo, false) "
    "AND coalesce(EersteJaarInHetHogerOnderwijs = Inschrijvingsjaar, false) THEN 'Ja' ELSE 'Nee' END")
SQL["seven_predicate_cohort"] = (
    f"WITH {EV} SELECT PersoonsgebondenNummer, Inschrijvingsjaar, {E12} AS InPACohortDefinitie FROM ev")
SQL["enrich_classification"] = (
    f"WITH {EV}, {LK} SELECT ev.PersoonsgebondenNummer, ev.Inschrijvingsjaar, c.ISCEDF2013Detailgroep, "
    "c.ISCEDF2013DetailgroepOmschrijving, c.ISCEDF2013Rubriek, c.ISCEDF2013RubriekOmschrijving FROM ev "
    "LEFT JOIN isced c ON ev.Opleidingscode IS NOT DISTINCT FROM c.Opleidingscode")
ENRICHED_JOINS = (
    "LEFT JOIN vopl2 v ON ev.HoogsteVooropleiding IS NOT DISTINCT FROM v.VooropleidingCode "
    "LEFT JOIN brin b ON ev.InstellingVanDeHoogsteVooropleiding IS NOT DISTINCT FROM b.Brinnummer "
    "AND ev.VestigingsnummerVanDeHoogsteVooropleiding IS NOT DISTINCT FROM b.Vestigingsnummer "
    "LEFT JOIN isat i ON ev.OpleidingActueelEquivalent IS NOT DISTINCT FROM i.Opleidingscode "
    "LEFT JOIN lokaal l ON ev.OpleidingActueelEquivalent IS NOT DISTINCT FROM l.Opleidingscode "
    "LEFT JOIN isced c ON ev.Opleidingscode IS NOT DISTINCT FROM c.Opleidingscode")
SQL["enriched_enrolments"] = (
    f"WITH {EV}, {LK}, {VOPL}, ev2 AS (SELECT *, {E9} AS HoDiplomaInEersteJaar, {E12} AS InPACohortDefinitie FROM ev) "
    "SELECT ev.PersoonsgebondenNummer, ev.Inschrijvingsjaar, CAST(1 AS BIGINT) AS Aantal, "
    "v.VooropleidingCode AS HoogsteVooropleidingCode, v.OmschrijvingVooropleiding AS HoogsteVooropleidingVolledig, "
    "v.ProfielVooropleiding AS HoogsteVooropleidingProfiel, v.Vooropleiding, "
    "b.NaamInstellingVooropleiding AS NaamInstellingHoogsteVooropleiding, i.NaamOpleiding AS NaamOpleidingCroho, "
    "coalesce(ev.OpleidingHistorischEquivalent, ev.OpleidingActueelEquivalent) AS opleiding, "
    f"coalesce({_case_map('ev.CrohoOnderdeelActueleOpleiding', SECTORS, 'ev.CrohoOnderdeelActueleOpleiding')}, 'onbekend') AS CrohoOnderdeel, "
    f"{_case_map('ev.OpleidingsfaseActueelVanHetDiploma', DKINDS, 'ev.OpleidingsfaseActueelVanHetDiploma')} AS SoortDiploma, "
    "ev.HoDiplomaInEersteJaar, "
    f"coalesce({_case_map('ev.Opleidingsfase', PTYPES, 'ev.Opleidingsfase')}, 'onbekend') AS TypeOpleiding, "
    "l.CodeOpleiding, l.NaamFaculteit, ev.InPACohortDefinitie, "
    "c.ISCEDF2013Rubriek, c.ISCEDF2013RubriekOmschrijving FROM ev2 AS ev " + ENRICHED_JOINS)

# --- cohorts ----------------------------------------------------------------
MAIN = "coalesce(TRY_CAST(SoortInschrijvingHogerOnderwijs AS BIGINT) = 1, false)"
AW_ORDER = "Diplomajaar NULLS LAST, DatumTekeningDiploma NULLS LAST"
COHORT = (
    f"WITH {EV}, "
    "enr2 AS (SELECT *, CAST(1 AS BIGINT) AS Aantal, "
    "coalesce(OpleidingHistorischEquivalent, OpleidingActueelEquivalent) AS opleiding, "
    f"{E9} AS HoDiplomaInEersteJaar, {E12} AS InPACohortDefinitie FROM ev), "
    "intake AS (SELECT * FROM enr2 WHERE coalesce(IndicatieActiefOpPeildatum = 1, false) AND "
    f"{MAIN} AND coalesce(Inschrijvingsjaar = EersteJaarAanDezeActueleInstelling, false)), "
    "y2 AS (SELECT PersoonsgebondenNummer, opleiding, ActueleInstelling, Opleidingsvorm, OpleidingActueelEquivalent "
    f"FROM enr2 WHERE coalesce(Inschrijvingsjaar = EersteJaarAanDezeActueleInstelling + 1, false) AND {MAIN}), "
    "c4 AS (SELECT i.*, y.opleiding AS opleiding_2ejaar, y.ActueleInstelling AS ActueleInstelling_2ejaar, "
    "y.Opleidingsvorm AS Opleidingsvorm_2ejaar, y.OpleidingActueelEquivalent AS OpleidingActueelEquivalent_2ejaar "
    "FROM intake i LEFT JOIN y2 y ON i.PersoonsgebondenNummer = y.PersoonsgebondenNummer), "
    "fl AS (SELECT *, coalesce(ActueleInstelling = ActueleInstelling_2ejaar, false) AS same_inst, "
    "coalesce(HoDiplomaInEersteJaar = 1, false) AS degree, "
    "(coalesce(opleiding = opleiding_2ejaar, false) OR coalesce(OpleidingActueelEquivalent = "
    "OpleidingActueelEquivalent_2ejaar, false)) AS same_prog FROM c4), "
    "k12 AS (SELECT *, CAST(CASE WHEN NOT (same_inst OR degree) THEN 1 ELSE 0 END AS BIGINT) AS UitvalEerstejaar, "
    "CAST(CASE WHEN same_prog THEN 1 ELSE 0 END AS BIGINT) AS opleiding_gelijk, "
    "CAST(CASE WHEN same_inst THEN 1 ELSE 0 END AS BIGINT) AS HerinschrijvingInstelling, "
    "CAST(CASE WHEN NOT same_prog AND (same_inst OR degree) AND NOT degree THEN 1 ELSE 0 END AS BIGINT) "
    "AS SwitchBinnenInstelling FROM fl), "
    "pd AS (SELECT * EXCLUDE (rn) FROM (SELECT PersoonsgebondenNummer, OpleidingActueelEquivalent, "
    "EersteJaarAanDezeActueleInstelling, DatumTekeningDiploma, opleiding, Diplomajaar AS JaarPropedeuseDiploma, "
    f"row_number() OVER (PARTITION BY PersoonsgebondenNummer ORDER BY {AW_ORDER}, opleiding NULLS LAST, "
    "OpleidingActueelEquivalent NULLS LAST, EersteJaarAanDezeActueleInstelling NULLS LAST) AS rn FROM enr2 "
    "WHERE Diplomajaar IS NOT NULL AND coalesce(OpleidingsfaseActueelVanHetDiploma = 'D', false)) WHERE rn = 1), "
    "k6 AS (SELECT k12.*, coalesce(pd.JaarPropedeuseDiploma = pd.EersteJaarAanDezeActueleInstelling, false) AS p1, "
    "coalesce(pd.JaarPropedeuseDiploma = pd.EersteJaarAanDezeActueleInstelling + 1, false) AS p2 FROM k12 "
    "LEFT JOIN pd ON k12.PersoonsgebondenNummer = pd.PersoonsgebondenNummer), "
    "k13 AS (SELECT *, CAST(CASE WHEN p1 THEN 1 ELSE 0 END AS BIGINT) AS PropedeuseIn1Jaar, "
    "CAST(CASE WHEN p1 OR p2 THEN 1 ELSE 0 END AS BIGINT) AS PropedeuseIn2Jaar, "
    "CAST(CASE WHEN UitvalEerstejaar = 1 AND p1 THEN 1 ELSE 0 END AS BIGINT) AS Uitval1JaarMetPropedeuse, "
    "CAST(CASE WHEN HerinschrijvingInstelling = 1 AND p1 THEN 1 ELSE 0 END AS BIGINT) AS HerinschrijvingMetPropedeuse "
    "FROM k6), "
    "aw AS (SELECT PersoonsgebondenNummer, OpleidingActueelEquivalent, opleiding, DatumTekeningDiploma, Diplomajaar, "
    "Opleidingsvorm, Aantal FROM enr2 WHERE coalesce(Diplomajaar <> 0, true) "
    "AND coalesce(OpleidingsfaseActueelVanHetDiploma = 'B', false)), "
    "a1 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY PersoonsgebondenNummer ORDER BY "
    f"{AW_ORDER}, opleiding NULLS LAST, OpleidingActueelEquivalent NULLS LAST, Opleidingsvorm NULLS LAST, "
    "Aantal NULLS LAST) AS rn FROM aw) WHERE rn = 1), "
    "k7 AS (SELECT k13.*, a1.Diplomajaar AS Diplomajaar_EenDiploma, a1.opleiding AS opleiding_EenDiploma, "
    "a1.OpleidingActueelEquivalent AS OpleidingActueelEquivalent_EenDiploma, a1.Aantal AS Aantal_EenDiploma, "
    "a1.DatumTekeningDiploma AS DatumTekeningDiploma_EenDiploma, a1.Opleidingsvorm AS Opleidingsvorm_EenDiploma, "
    "CAST(coalesce(a1.Aantal, 0) AS BIGINT) AS BachelorDiploma, "
    "a1.Diplomajaar - k13.EersteJaarAanDezeActueleInstelling AS JaarTotEenDiploma FROM k13 "
    "LEFT JOIN a1 ON k13.PersoonsgebondenNummer = a1.PersoonsgebondenNummer), "
    "a2 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY PersoonsgebondenNummer, opleiding "
    f"ORDER BY {AW_ORDER}, OpleidingActueelEquivalent NULLS LAST, Opleidingsvorm NULLS LAST, Aantal NULLS LAST) "
    "AS rn FROM aw) WHERE rn = 1), "
    "k8 AS (SELECT k7.*, a2.Diplomajaar AS Diplomajaar_DitDiploma, a2.DatumTekeningDiploma AS "
    "DatumTekeningDiploma_DitDiploma, a2.OpleidingActueelEquivalent AS OpleidingActueelEquivalent_DitDiploma, "
    "a2.Opleidingsvorm AS Opleidingsvorm_DitDiploma, a2.Aantal AS Aantal_DitDiploma "
    "FROM k7 LEFT JOIN a2 ON k7.PersoonsgebondenNummer = a2.PersoonsgebondenNummer "
    "AND k7.opleiding IS NOT DISTINCT FROM a2.opleiding), "
    "k15 AS (SELECT *, CASE WHEN HoDiplomaInEersteJaar = 1 THEN 'HoDiplomaInEersteJaar' "
    "WHEN SwitchBinnenInstelling = 1 THEN 'SwitchBinnenInstelling' WHEN UitvalEerstejaar = 1 THEN 'ValtUitInJaar1' "
    "ELSE 'StudeertNogAanHsl' END AS StatusNa1Jaar, Inschrijvingsjaar AS Cohort, "
    "CASE InPACohortDefinitie WHEN 'Ja' THEN 'EersteKeerHO' WHEN 'Nee' THEN 'EersteKeerHsl' "
    "ELSE InPACohortDefinitie END AS CohortType, "
    "CASE TypeHogerOnderwijsBinnenSoortHogerOnderwijs WHEN 'ba' THEN 'bachelor' WHEN 'ma' THEN 'master' "
    "WHEN 'ad' THEN 'associate degree' ELSE TypeHogerOnderwijsBinnenSoortHogerOnderwijs END AS TypeOpleidingNiveau "
    "FROM k8) "
)
WITHIN = ", ".join(
    f"CAST(CASE WHEN coalesce(JaarTotEenDiploma <= {n - 1}, false) THEN 1 ELSE 0 END AS BIGINT) AS EenDiplomaBinnen{n}jaar"
    for n in (4, 5, 6, 7, 8))
SQL["intake"] = COHORT + "SELECT PersoonsgebondenNummer, Inschrijvingsjaar, ActueleInstelling, opleiding FROM intake"
SQL["second_year"] = COHORT + "SELECT * FROM y2"
SQL["first_award"] = COHORT + "SELECT * FROM pd"
SQL["awards"] = COHORT + "SELECT * FROM aw"
SQL["cohort_year2"] = COHORT + (
    "SELECT PersoonsgebondenNummer, Inschrijvingsjaar, ActueleInstelling_2ejaar, opleiding_2ejaar, "
    "Opleidingsvorm_2ejaar, OpleidingActueelEquivalent_2ejaar FROM c4")
SQL["award_in_1_2_years"] = COHORT + (
    "SELECT PersoonsgebondenNummer, PropedeuseIn1Jaar, PropedeuseIn2Jaar, Uitval1JaarMetPropedeuse, "
    "HerinschrijvingMetPropedeuse FROM k15")
SQL["award_within_n_years"] = COHORT + (
    f"SELECT PersoonsgebondenNummer, BachelorDiploma, JaarTotEenDiploma, {WITHIN} FROM k15")
SQL["award_same_programme"] = COHORT + (
    "SELECT PersoonsgebondenNummer, opleiding, Diplomajaar_DitDiploma, DatumTekeningDiploma_DitDiploma, "
    "OpleidingActueelEquivalent_DitDiploma FROM k15")
SQL["retention_flags"] = COHORT + (
    "SELECT PersoonsgebondenNummer, UitvalEerstejaar, opleiding_gelijk, HerinschrijvingInstelling, "
    "SwitchBinnenInstelling FROM k15")
SQL["status_after_year1"] = COHORT + "SELECT PersoonsgebondenNummer, StatusNa1Jaar FROM k15"
SQL["cohort_hot_split"] = COHORT + (
    "SELECT PersoonsgebondenNummer, StatusNa1Jaar, UitvalEerstejaar, PropedeuseIn1Jaar, JaarTotEenDiploma, "
    "Diplomajaar_DitDiploma FROM k15")
SQL["cohort_full"] = COHORT + (
    ", k16 AS (SELECT *, " + WITHIN + " FROM k15) "
    "SELECT Cohort, CohortType, TypeOpleidingNiveau AS TypeOpleiding, StatusNa1Jaar, count(*) AS students, "
    "CAST(sum(UitvalEerstejaar) AS BIGINT) AS dropouts, CAST(sum(PropedeuseIn1Jaar) AS BIGINT) AS propaedeutic_1y, "
    "CAST(sum(BachelorDiploma) AS BIGINT) AS bachelors, CAST(sum(EenDiplomaBinnen5jaar) AS BIGINT) AS bachelor_5y "
    "FROM k16 GROUP BY ALL")

COHORT_WHOLE = (
    f"WITH {EV}, {LK}, {VOPL}, ev2 AS (SELECT *, {E9} AS HoDiplomaInEersteJaar, {E12} AS InPACohortDefinitie FROM ev), "
    "enr2 AS (SELECT ev.*, CAST(1 AS BIGINT) AS Aantal, v.VooropleidingCode AS HoogsteVooropleidingCode, "
    "v.OmschrijvingVooropleiding AS HoogsteVooropleidingVolledig, v.ProfielVooropleiding AS HoogsteVooropleidingProfiel, v.Vooropleiding, "
    "b.NaamInstellingVooropleiding AS NaamInstellingHoogsteVooropleiding, b.PostcodeInstellingVooropleiding AS PostcodeInstellingHoogsteVooropleiding, "
    "b.PlaatsInstellingVooropleiding AS PlaatsInstellingHoogsteVooropleiding, "
    "b.DatumOprichtingInstellingVooropleiding AS DatumOprichtingInstellingHoogsteVooropleiding, "
    "b.DatumOpheffingInstellingVooropleiding AS DatumOpheffingInstellingHoogsteVooropleiding, "
    "b.DenominatieInstellingVooropleidingCode AS CodeDenominatieInstellingHoogsteVooropleiding, "
    "b.NaamDenominatieInstellingVooropleiding AS DenominatieInstellingHoogsteVooropleiding, i.NaamOpleiding AS NaamOpleidingCroho, "
    "coalesce(ev.OpleidingHistorischEquivalent, ev.OpleidingActueelEquivalent) AS opleiding, "
    f"coalesce({_case_map('ev.CrohoOnderdeelActueleOpleiding', SECTORS, 'ev.CrohoOnderdeelActueleOpleiding')}, 'onbekend') AS CrohoOnderdeel, "
    f"{_case_map('ev.OpleidingsfaseActueelVanHetDiploma', DKINDS, 'ev.OpleidingsfaseActueelVanHetDiploma')} AS SoortDiploma, "
    "l.CodeOpleiding, l.NaamOpleiding, l.NaamFaculteit, l.CodeFaculteit, c.ISCEDF2013Detailgroep, c.ISCEDF2013DetailgroepOmschrijving, "
    "c.ISCEDF2013Rubriek, c.ISCEDF2013RubriekOmschrijving FROM ev2 AS ev " + ENRICHED_JOINS + "), ")
SQL["cohort_rows"] = COHORT_WHOLE + COHORT[COHORT.index("intake AS"):] + (
    "SELECT * EXCLUDE (same_inst, degree, same_prog, p1, p2, TypeOpleidingNiveau), TypeOpleidingNiveau AS TypeOpleiding, " + WITHIN + " FROM k15")

# --- exam grades ----------------------------------------------------------------
EXAM = f"ex AS ({V.select_sql(V.EXAM_EXPRS, 'lineitem')})"
MELT = " UNION ALL ".join(
    f"SELECT PersoonsgebondenNummer, Diplomajaar, VakCode, VakAfkorting, '{c}' AS variable, {c} AS value FROM ex "
    f"WHERE {c} IS NOT NULL"
    for c in ("CijferEersteCentraalExamen", "CijferTweedeCentraalExamen", "CijferDerdeCentraalExamen",
              "CijferSchoolexamen"))
SQL["unpivot_grades"] = f"WITH {EXAM} {MELT}"
MELT_V = MELT.replace("SELECT PersoonsgebondenNummer, Diplomajaar", "SELECT PersoonsgebondenNummer, Vooropleiding, Diplomajaar")
GRADED = (
    f"WITH {EXAM}, vo AS ({V.DEC_VOOROPL_SQL}), "
    "ex2 AS (SELECT ex.*, "
    f"{_classify('vo.OmschrijvingVooropleidingOorspronkelijkeCode')} AS Vooropleiding FROM ex LEFT JOIN vo "
    "ON ex.VooropleidingOorspronkelijkeCode IS NOT DISTINCT FROM vo.VooropleidingOorspronkelijkeCode), "
    f"long AS ({MELT_V.replace('FROM ex ', 'FROM ex2 ')}), "
    "g AS (SELECT *, CAST(CASE WHEN contains(variable, 'Eerste') THEN 1 WHEN contains(variable, 'Tweede') THEN 2 "
    "WHEN contains(variable, 'Derde') THEN 3 ELSE 1 END AS BIGINT) AS Poging, "
    "CASE WHEN contains(variable, 'Centraal') THEN 'CSE' ELSE 'School' END AS SoortExamen FROM long) "
)
SQL["attempt_and_kind"] = GRADED + "SELECT PersoonsgebondenNummer, VakCode, variable, value, Poging, SoortExamen FROM g"
LAST = GRADED + (
    "SELECT PersoonsgebondenNummer, Vooropleiding, Diplomajaar, VakCode, VakAfkorting, value AS Cijfer, Poging, "
    "SoortExamen FROM (SELECT *, row_number() OVER (PARTITION BY PersoonsgebondenNummer, Vooropleiding, SoortExamen, "
    "VakAfkorting, VakCode ORDER BY Poging DESC NULLS LAST, Diplomajaar DESC NULLS LAST, value DESC NULLS LAST, "
    "variable NULLS LAST) AS rn FROM g) WHERE rn = 1")
SQL["last_attempt"] = LAST
SQL["exam_grades"] = LAST

# --- sinks ---------------------------------------------------------------------
NATION_REGION = ("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, r_name FROM nation "
                 "LEFT JOIN region ON n_regionkey = r_regionkey")
SQL["sink_parquet"] = ("SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS "
                       "c_nationkey, c_acctbal FROM customer")
SQL["sink_csv"] = NATION_REGION
SQL["publish_table_view"] = NATION_REGION

# --- workflows -------------------------------------------------------------
SQL["convert_quarantine"] = (
    "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE NULLIF(trim(p_brand), '') END AS p_brand, "
    "CASE WHEN p_type = 'PROMO' THEN 'XTRA' || CAST(p_size AS STRING) END AS GarbageColumn FROM part")
SQL["conversion_accounts"] = (
    "WITH n AS (SELECT count(*) FILTER (WHERE c_custkey % 500 = 0) AS bad, count(*) AS records FROM customer) "
    "SELECT 'Dec_klant' AS table_name, 'c_nationkey' AS column_name, bad AS unreadable, records, "
    "'written; unreadable cells: c_nationkey ' || bad AS status, bad AS null_cells FROM n WHERE bad > 0")
LOCAL_ID = "CASE WHEN {0} % 2 = 0 THEN 'S' || CAST({0} AS STRING) END AS studentnummer"
SQL["convert_local_ids"] = (
    f"SELECT sha256('{SALT}' || lpad(CAST(o_custkey AS STRING), 12, '0')) AS PersoonsgebondenNummer, CAST(o_orderkey AS BIGINT) AS nummer, "
    f"{LOCAL_ID.format('o_custkey')}, 'EVlokaal' AS tabel FROM orders UNION ALL "
    f"SELECT sha256('{SALT}' || lpad(CAST(c_custkey AS STRING), 12, '0')), CAST(c_nationkey AS BIGINT), {LOCAL_ID.format('c_custkey')}, 'VAKHAVlokaal' FROM customer")
SQL["dated_layouts"] = (
    f"SELECT CAST(c_custkey AS BIGINT) AS c_custkey, {_cell('substr(c_name, 1, 25)')} AS c_name, "
    "CASE WHEN c_custkey % 3 = 0 THEN 'N' || lpad(CAST(c_nationkey AS STRING), 3, '0') ELSE CAST(c_nationkey AS STRING) END AS c_nationkey, "
    f"CASE WHEN c_custkey % 3 = 0 THEN {_cell('substr(c_mktsegment, 1, 10)')} END AS c_mktsegment FROM customer")
SQL["converted_types"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'K' END || CAST(o_custkey AS STRING) AS klant, "
    "CASE WHEN o_orderkey % 2 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') ELSE strftime(CAST(o_orderdate AS DATE), '%d-%m-%Y') END AS day FROM orders")
PROFILE = ("SELECT '{c}' AS column, CAST(2 AS BIGINT) AS n_deliveries, count(*) AS n_rows, count(*) - count({e}) AS n_null, "
           "{low} AS least_number, {high} AS greatest_number, {lt} AS least_text, {ht} AS greatest_text FROM lineitem")
NO_TEXT, NO_NUMBER = {"lt": "CAST(NULL AS STRING)", "ht": "CAST(NULL AS STRING)"}, {"low": "CAST(NULL AS DOUBLE)", "high": "CAST(NULL AS DOUBLE)"}
SQL["column_profile"] = " UNION ALL ".join(
    [PROFILE.format(c=c, e=e, low=f"CAST(min({e}) AS DOUBLE)", high=f"CAST(max({e}) AS DOUBLE)", **NO_TEXT) for c, e in
     (("l_orderkey", "l_orderkey"), ("l_suppkey", "(CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END)"), ("l_quantity", "l_quantity"))]
    + [PROFILE.format(c="l_returnflag", e="l_returnflag", lt="min(l_returnflag)", ht="max(l_returnflag)", **NO_NUMBER)])
SQL["assets_unmatched_report"] = SQL["local_names_unmatched"]
SQL["publish_failed"] = NATION_REGION
SQL["sink_balanced"] = (
    "WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 1995 ELSE year(o_orderdate) END AS jaar, o_totalprice FROM orders) "
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(jaar AS BIGINT) AS jaar, CASE WHEN jaar IN (1996, 1997) THEN 0.5 ELSE o_totalprice END AS bedrag FROM o")
SQL["two_key_lookup_kinds"] = (
    f"WITH {EV}, {LK} SELECT ev.PersoonsgebondenNummer, ev.Inschrijvingsjaar, ev.InstellingVanDeHoogsteVooropleiding, "
    "ev.VestigingsnummerVanDeHoogsteVooropleiding, v.NaamInstellingVooropleiding AS NaamInstellingHoogsteVooroplVoorHetHo, "
    "v.PlaatsInstellingVooropleiding AS PlaatsInstellingHoogsteVooroplVoorHetHo, "
    "b.NaamInstellingVooropleiding AS NaamInstellingHoogsteVooroplBinnenHetHo, "
    "b.DatumOprichtingInstellingVooropleiding AS DatumOprichtingInstellingHoogsteVooroplBinnenHetHo FROM ev "
    "LEFT JOIN brin v ON ev.InstellingVanDeHoogsteVooropleiding IS NOT DISTINCT FROM v.Brinnummer AND v.Vestigingsnummer = '00' "
    "LEFT JOIN brin b ON b.Brinnummer = '0017' AND ev.VestigingsnummerVanDeHoogsteVooropleiding IS NOT DISTINCT FROM b.Vestigingsnummer")
