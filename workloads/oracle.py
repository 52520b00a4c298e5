"""The same queries as plain SQL on the given tables."""

from __future__ import annotations

from workloads.funding_sql import funding_sql

# Orders and line items with the keys of their delivery, person and enrolment.
O = """
o AS (
  SELECT *, cast(year(o_orderdate) AS varchar) AS levering,
    CASE WHEN o_custkey % 5 != 0 THEN cast(o_custkey AS varchar) END AS bsn,
    CASE WHEN o_custkey % 5 = 0 THEN 'ON' || o_custkey END AS onr,
    coalesce(CASE WHEN o_custkey % 5 != 0 THEN cast(o_custkey AS varchar) END, 'ON' || o_custkey) AS pid,
    cast(o_orderkey AS varchar) AS vnr, cast(o_orderdate AS date) AS dag
  FROM orders)"""
L = f"""{O},
l AS (
  SELECT lineitem.*, levering, bsn, onr, pid, vnr, o_orderstatus, cast(l_shipdate AS date) AS verzonden,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS volgorde,
    CASE WHEN l_linestatus != 'F' OR o_orderstatus = 'F' THEN vnr END AS hersteld
  FROM lineitem JOIN o ON l_orderkey = o_orderkey)"""
# First person row per delivery and person.
P = """
p AS (
  SELECT levering, pid, dag AS "Geboortedatum", o_orderstatus AS "Geslacht"
  FROM (SELECT *, row_number() OVER (PARTITION BY levering, pid ORDER BY o_orderkey) AS rn FROM o) WHERE rn = 1)"""

EVEN = "cast(levering AS int) % 2 = 0"
ISO = "strftime({}, '%Y-%m-%d')"
DUTCH = "strftime({}, '%-d-%-m-%Y')"


def text_day(column: str) -> str:
    return f"CASE WHEN {EVEN} THEN {ISO.format(column)} ELSE {DUTCH.format(column)} END"


PERSON_TEXT = "coalesce(bsn, '') AS \"Burgerservicenummer\", coalesce(onr, '') AS \"Onderwijsnummer\""
PERSON = 'bsn AS "Burgerservicenummer", onr AS "Onderwijsnummer"'
PID = "pid AS _persoon_id"
VNR = 'vnr AS "Inschrijvingvolgnummer"'

ISP = f"""levering, {PERSON}, {VNR}, verzonden AS "DatumBegin",
  cast(l_partkey AS varchar) AS "Opleidingcode", l_returnflag AS "Leertraject", l_linestatus AS "Niveau",
  CASE WHEN l_linestatus = 'O' THEN 'J' ELSE 'N' END AS "IndicatieBekostigbaar",
  cast(l_suppkey AS varchar) AS "Onderwijsaanbieder", cast(l_linenumber AS varchar) AS "Leerroute", {PID}"""

VLP = """v AS (
  SELECT levering, 'B' || levering AS "BRIN", min(dag) AS "DatumBeginPeriode", max(dag) AS "DatumEindePeriode",
    cast(max(dag) + 1 AS date) AS "DatumAanmaak" FROM o GROUP BY levering)"""

ISG_COLUMNS = """o.dag AS "DatumInschrijving", cast(o.dag + 365 AS date) AS "DatumUitschrijvingGepland",
  CASE WHEN o.o_orderstatus = 'F' THEN cast(o.dag + 90 AS date) END AS "DatumUitschrijvingWerkelijk",
  o.o_orderpriority AS "RedenUitschrijving" """

OUTCOME = """CASE l_linenumber WHEN 4 THEN NULL WHEN 5 THEN 'Vrijgesteld' ELSE
  CASE l_returnflag WHEN 'A' THEN 'Behaald' WHEN 'N' THEN 'Niet behaald' WHEN 'R' THEN 'BEHAALD' END END"""
WITH_WORD = "l_linenumber NOT IN (4, 5)"
# Every seventh order has no hours at all.
HOURS = "CASE WHEN l_orderkey % 7 != 0 THEN l_quantity END"

BPV_TOTALS = f"""count(*) AS "BPV_Aantal", cast(coalesce(sum({HOURS}), 0) AS double) AS "BPV_TotaalOmvang",
  min(verzonden) AS "BPV_DatumBeginEerste",
  max(CASE WHEN l_linestatus = 'F' THEN cast(verzonden + 10 AS date) END) AS "BPV_DatumEindLaatste" """


def exam_columns() -> str:
    parts = []
    for code in range(3001, 3008):
        here = f"FILTER (WHERE 3000 + l_linenumber = {code})"
        parts += [
            f'max(cast(l_quantity AS bigint)) {here} AS "GEO_{code}_Eindcijfer"',
            f'max(cast(round(l_discount * 100) AS bigint)) {here} AS "GEO_{code}_CijferIE"',
            f'max(cast(round(l_tax * 100) AS bigint)) {here} AS "GEO_{code}_CijferCE"',
            f'max(CASE WHEN eerste AND l_returnflag != \'N\' THEN l_returnflag END) {here} AS "GEO_{code}_Vrijstelling"',
        ]
    return ",\n  ".join(parts)


# First row per enrolment and exam code is marked, as its exemption counts.
EXAMS = f"""g AS (
  SELECT levering, pid, hersteld AS vnr, {exam_columns()}
  FROM (SELECT *, row_number() OVER (PARTITION BY levering, pid, hersteld, l_linenumber ORDER BY volgorde) = 1 AS eerste
        FROM l WHERE hersteld IS NOT NULL)
  GROUP BY levering, pid, hersteld)"""

KEY = f"levering, {PID}, {VNR}"
REPAIRED_KEY = 'levering, pid AS _persoon_id, hersteld AS "Inschrijvingvolgnummer"'

WIDE = f"""WITH {L}, {P}, {VLP}, b AS (SELECT levering, pid, vnr, {BPV_TOTALS} FROM l GROUP BY levering, pid, vnr),
w AS (
  SELECT l.*, "BPV_Aantal", "BPV_TotaalOmvang" FROM l JOIN b USING (levering, pid, vnr))
"""

RENDERED_DATES = """SELECT levering, vnr AS "Inschrijvingvolgnummer", dag AS "DatumInschrijving",
  cast(NULL AS date) AS "DatumUitschrijvingGepland",
  CASE WHEN o_orderkey % 7 != 0 THEN cast(dag + 9 AS date) END AS "DatumUitschrijvingWerkelijk" FROM o"""

XML_DATES = """n AS (SELECT unnest([1, 2]) AS nr),
t AS (
  SELECT * FROM l JOIN n ON (l_returnflag = 'A' AND nr = 1) OR l_returnflag = 'N')"""

SQL = {
    "multirecord_parse": f"""WITH {L}
SELECT levering, 'PER' AS "Recordsoort", {PERSON_TEXT}, {text_day("dag")} AS "Geboortedatum",
  o_orderstatus AS "Geslacht", cast(NULL AS varchar) AS "Inschrijvingvolgnummer",
  cast(NULL AS varchar) AS "DatumInschrijving", cast(NULL AS varchar) AS "DatumUitschrijvingGepland",
  cast(NULL AS varchar) AS "DatumUitschrijvingWerkelijk", cast(NULL AS varchar) AS "RedenUitschrijving",
  cast(NULL AS varchar) AS "DatumBegin", cast(NULL AS varchar) AS "Opleidingcode",
  cast(NULL AS varchar) AS "Leertraject", cast(NULL AS varchar) AS "Niveau",
  cast(NULL AS varchar) AS "IndicatieBekostigbaar", cast(NULL AS varchar) AS "LocatiecodeVSV",
  cast(NULL AS varchar) AS "Onderwijsaanbieder", cast(NULL AS varchar) AS "Onderwijslocatie",
  cast(NULL AS varchar) AS "Leerroute", cast(NULL AS varchar) AS "Leerroutefase"
FROM o
UNION ALL
SELECT levering, 'ISG', {PERSON_TEXT}, NULL, NULL, vnr, {text_day("dag")}, {text_day("dag + INTERVAL 365 DAY")}, '',
  o_orderpriority, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM o
UNION ALL
SELECT levering, 'ISP', {PERSON_TEXT}, NULL, NULL, vnr, NULL, NULL, NULL, NULL, {text_day("verzonden")},
  cast(l_partkey AS varchar), l_returnflag, l_linestatus, CASE WHEN l_linestatus = 'O' THEN 'J' ELSE 'N' END,
  '', '', '', '', '' FROM l""",
    "record_type_counts": f"""WITH {L}
SELECT levering, 'VLP' AS recordtype, cast(1 AS bigint) AS aantal FROM o GROUP BY levering
UNION ALL SELECT levering, 'PER', count(*) FROM o GROUP BY levering
UNION ALL SELECT levering, 'ISG', count(*) FROM o GROUP BY levering
UNION ALL SELECT levering, 'ISP', count(*) FROM l GROUP BY levering""",
    "separator_detect": f"""WITH {O}
SELECT levering, CASE WHEN {EVEN} THEN '|' ELSE ';' END AS scheidingsteken,
  CASE WHEN {EVEN} THEN 'iso' ELSE 'dutch' END AS _datumformaat FROM o GROUP BY levering""",
    "width_normalise": f"""WITH {O}
SELECT levering, 'PER' AS "Recordsoort", coalesce(bsn, '') AS "Burgerservicenummer",
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE coalesce(onr, '') END AS "Onderwijsnummer",
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE {ISO.format("dag")} END AS "Geboortedatum",
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS "Geslacht" FROM o""",
    "encoding_fallback": f"""WITH {O}
SELECT levering, 'PER' AS "Recordsoort", {PERSON_TEXT}, {ISO.format("dag")} AS "Geboortedatum",
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus || 'é' ELSE o_orderstatus END AS "Geslacht" FROM o""",
    "date_decode_iso": f"WITH {O} {RENDERED_DATES}",
    "date_decode_compact": f"WITH {O} {RENDERED_DATES}",
    "date_decode_dutch": f"WITH {O} {RENDERED_DATES}",
    "dates_lost": f"""WITH {O}
SELECT levering, 'ISG' AS recordtype, 'DatumUitschrijvingGepland' AS veld, count(*) AS verloren FROM o GROUP BY levering
UNION ALL
SELECT levering, 'ISG', 'DatumUitschrijvingWerkelijk', count(*) FROM o WHERE o_orderkey % 7 = 0 GROUP BY levering""",
    "typed_decode": f"""WITH {L}
SELECT levering, 'BPV' AS "Recordsoort", {PERSON}, {VNR}, cast(l_linenumber AS varchar) AS "Volgnummer",
  cast(NULL AS date) AS "Afsluitdatum", verzonden AS "DatumBegin", cast(NULL AS date) AS "DatumEindGepland",
  cast(NULL AS date) AS "DatumEindWerkelijk",
  CASE WHEN l_linestatus = 'O' THEN cast(l_quantity AS bigint) END AS "Omvang",
  cast(NULL AS varchar) AS "LeerbedrijfID", cast(NULL AS varchar) AS "Opleidingcode",
  cast(NULL AS varchar) AS "CodeKeuzedeel" FROM l""",
    "quarantine": f"""WITH {L}
SELECT DISTINCT levering, 'decoderen' AS fase, 'BPV: geen getal in Omvang' AS reden
FROM l WHERE cast(levering AS int) % 3 = 0 AND l_linenumber = 7
UNION ALL
SELECT DISTINCT levering, 'valideren', 'VLP moet exact 1 rij bevatten, gevonden: 2'
FROM o WHERE cast(levering AS int) % 3 = 1""",
    "family_detect": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'ro' WHEN o_orderstatus = 'O' THEN 'grondslag'
    WHEN o_orderstatus = 'P' THEN 'tbgi' END AS bestandstype,
  CASE WHEN o_orderkey % 2 = 0 THEN 'h' || (o_orderkey % 10) ELSE 'overig' END || '/' ||
  CASE WHEN o_orderkey % 5 = 0 THEN 'notes_' WHEN o_orderstatus = 'F' THEN 'ro_'
    WHEN o_orderstatus = 'O' THEN 'GRONDSLAG_IP_MBO_' ELSE 'Tbgi_' END || o_orderkey || '.v1' AS label
FROM orders""",
    "xml_explode_teldatum": f"""WITH {L}, {XML_DATES}
SELECT levering, 'B' || levering AS "BRIN", {VNR}, cast(verzonden + nr AS date) AS "Teldatum",
  cast(l_partkey AS varchar) AS "Opleidingcode", l_quantity AS "BBLBOLFactor",
  cast(l_linenumber AS bigint) AS "LeeftijdOpEenAugustusStudiejaar", cast(l_suppkey AS varchar) AS "BPV_Volgnummer",
  verzonden AS "BPV_DatumBegin", cast(NULL AS date) AS "BPV_DatumEindWerkelijk" FROM t""",
    "xml_signaal_union": f"""WITH {L}, {XML_DATES}
SELECT levering, 'Inschrijving' AS "Bron", 'B' || levering AS "BRIN", {VNR},
  strftime(verzonden + nr, '%Y-%m-%d') AS "Teldatum", cast(NULL AS varchar) AS "Resultaatvolgnummer",
  cast(nr AS bigint) AS "Signaalvolgnummer", l_returnflag AS "Signaalcode",
  cast(NULL AS varchar) AS "Signaalomschrijving", cast(1 AS bigint) AS "Parametervolgnummer",
  'p1' AS "Parameternaam", cast(NULL AS varchar) AS "Parameterwaarde" FROM t
UNION ALL
SELECT levering, 'Diploma', 'B' || levering, NULL, NULL, 'R' || o_orderkey, 9, o_orderpriority, NULL, NULL, NULL, NULL
FROM o""",
    "xml_inschrijving_diploma": f"""WITH {L}
SELECT levering, {PERSON}, {VNR}, verzonden AS "DatumInschrijving",
  cast(NULL AS varchar) AS "Resultaatvolgnummer", cast(NULL AS date) AS "DatumBehaald" FROM l
UNION ALL
SELECT levering, bsn, NULL, NULL, NULL, 'R' || o_orderkey, dag FROM o""",
    "union_drift": """SELECT l_orderkey AS sleutel, cast(l_linenumber AS double) AS getal, l_quantity AS maat,
  l_returnflag AS kenmerk, cast(NULL AS varchar) AS status FROM lineitem
UNION ALL
SELECT o_orderkey, o_totalprice, NULL, cast(o_custkey AS varchar), o_orderstatus FROM orders""",
    "label_stack": """SELECT o_orderstatus AS levering, o_orderkey, cast(o_orderdate AS date) AS dag,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey FROM orders""",
    "csv_round_trip": """SELECT p_partkey, '"' || p_name || ', ' || p_brand || '"' AS naam,
  nullif(p_type, 'ECONOMY') AS soort, p_size FROM part""",
    "run_counts": """SELECT 'PER' AS tabel, count(*) AS rijen FROM orders
UNION ALL SELECT 'DIP', count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 'AMO', count(*) FROM lineitem""",
    "persoon_coalesce": f"""WITH {O} SELECT levering, {PID}, dag AS "Geboortedatum" FROM o""",
    "keep_first_join": f"""WITH {L}, {P}
SELECT levering, {PID}, cast(l_partkey AS varchar) AS "Opleidingcode", cast(l_linenumber AS varchar) AS "Leerroute",
  "Geboortedatum", "Geslacht" FROM l LEFT JOIN p USING (levering, pid)""",
    "fk_repair_kzd": f"""WITH {L}
SELECT {REPAIRED_KEY}, 'R' || l_orderkey AS "ResultaatvolgnummerDiploma", 'K' || l_partkey AS "CodeKeuzedeel" FROM l""",
    "fk_repair_fanout": f"""WITH {L}
SELECT {REPAIRED_KEY}, 'C' || l_suppkey AS "CodeAMvBOnderdeel" FROM l
UNION ALL
SELECT levering, pid, CASE WHEN l_linestatus = 'F' THEN 'X' || vnr ELSE vnr END, 'C' || l_suppkey
FROM l WHERE o_orderstatus = 'F'""",
    "geo_pivot": f"""WITH {L}, {EXAMS}
SELECT {KEY}, * EXCLUDE (levering, pid, vnr) FROM g""",
    "bpv_aggregate": f"""WITH {L} SELECT {KEY}, {BPV_TOTALS} FROM l GROUP BY levering, pid, vnr""",
    "kzd_aggregate": f"""WITH {L}
SELECT {REPAIRED_KEY}, count(*) AS "KZD_Aantal", count(*) FILTER (WHERE {WITH_WORD}) AS "KZD_AantalBehaald"
FROM l WHERE hersteld IS NOT NULL GROUP BY levering, pid, hersteld""",
    "kzd_exact": f"""WITH {L}
SELECT {REPAIRED_KEY}, count(*) AS "KZD_Aantal",
  count(*) FILTER (WHERE {WITH_WORD} AND l_returnflag IN ('A', 'R')) AS "KZD_AantalBehaald"
FROM l WHERE hersteld IS NOT NULL GROUP BY levering, pid, hersteld""",
    "amo_aggregate": f"""WITH {L}
SELECT {REPAIRED_KEY}, count(*) AS "AMO_Aantal"
FROM l WHERE hersteld IS NOT NULL GROUP BY levering, pid, hersteld""",
    "validate_single_row": f"""WITH {O}
SELECT levering, 'VLP' AS recordtype, count(DISTINCT o_orderstatus) AS aantal FROM o
GROUP BY levering HAVING count(DISTINCT o_orderstatus) != 1""",
    "obt_base": f"""WITH {L}, {P}, {VLP},
i AS (SELECT {ISP}, l_orderkey FROM l)
SELECT i.* EXCLUDE (l_orderkey), p."Geboortedatum", p."Geslacht", {ISG_COLUMNS}, v.* EXCLUDE (levering)
FROM i LEFT JOIN p ON i.levering = p.levering AND i._persoon_id = p.pid
  LEFT JOIN o ON i.l_orderkey = o.o_orderkey LEFT JOIN v ON i.levering = v.levering""",
    "obt_full": f"""WITH {L}, {P}, {VLP}, {EXAMS},
i AS (SELECT {ISP}, l_orderkey FROM l),
b AS (SELECT vnr, {BPV_TOTALS} FROM l GROUP BY vnr),
k AS (SELECT hersteld AS vnr, count(*) AS "KZD_Aantal", count(*) FILTER (WHERE {WITH_WORD}) AS "KZD_AantalBehaald",
      FROM l WHERE hersteld IS NOT NULL GROUP BY hersteld),
a AS (SELECT hersteld AS vnr, count(*) AS "AMO_Aantal"
      FROM l WHERE hersteld IS NOT NULL GROUP BY hersteld),
e AS (SELECT vnr, dag AS "ISE_DatumBegin", cast(dag + 30 AS date) AS "ISE_DatumEind" FROM o
      WHERE o_orderpriority = '1-URGENT'),
d AS (SELECT vnr, 'R' || o_orderkey AS "DIP_Resultaatvolgnummer", o_orderpriority AS "DIP_Opleidingcode",
        cast(dag + 60 AS date) AS "DIP_DatumResultaat", 'J' AS "DIP_IndicatieBekostigbaar" FROM o
      WHERE o_orderstatus = 'F')
SELECT i.* EXCLUDE (l_orderkey), p."Geboortedatum", p."Geslacht", {ISG_COLUMNS}, v.* EXCLUDE (levering),
  e.* EXCLUDE (vnr), d.* EXCLUDE (vnr), g.* EXCLUDE (levering, pid, vnr), b.* EXCLUDE (vnr), k.* EXCLUDE (vnr),
  a.* EXCLUDE (vnr)
FROM i LEFT JOIN p ON i.levering = p.levering AND i._persoon_id = p.pid
  LEFT JOIN o ON i.l_orderkey = o.o_orderkey LEFT JOIN v ON i.levering = v.levering
  LEFT JOIN e ON i."Inschrijvingvolgnummer" = e.vnr LEFT JOIN d ON i."Inschrijvingvolgnummer" = d.vnr
  LEFT JOIN g ON i."Inschrijvingvolgnummer" = g.vnr LEFT JOIN b ON i."Inschrijvingvolgnummer" = b.vnr
  LEFT JOIN k ON i."Inschrijvingvolgnummer" = k.vnr LEFT JOIN a ON i."Inschrijvingvolgnummer" = a.vnr""",
    "detail_bpv": f"""WITH {L}
SELECT levering, {PID}, {PERSON}, {VNR}, cast(l_linenumber AS varchar) AS "Volgnummer", verzonden AS "DatumBegin",
  CASE WHEN l_linestatus = 'F' THEN cast(verzonden + 10 AS date) END AS "DatumEindWerkelijk",
  cast({HOURS} AS bigint) AS "Omvang" FROM l""",
    "detail_kzd_amo": f"""WITH {L}
SELECT levering, {PERSON}, 'R' || l_orderkey AS "ResultaatvolgnummerDiploma",
  hersteld AS "Inschrijvingvolgnummer", 'K' || l_partkey AS "CodeKeuzedeel", {OUTCOME} AS "Resultaat", {PID},
  'KZD' AS _bron, cast(NULL AS varchar) AS "CodeAMvBOnderdeel" FROM l
UNION ALL
SELECT levering, bsn, onr, 'R' || l_orderkey, hersteld, NULL, NULL, pid, 'AMO', 'C' || l_suppkey
FROM l""",
    "detail_bekostiging": f"""WITH {L}
SELECT levering, {PERSON}, 'B' || levering AS "BRIN", {VNR}, dag AS "Teldatum",
  substr(o_orderpriority, 1, 1) AS "BBLBOLFactor", {PID}, 'BII' AS _bron FROM o
UNION ALL
SELECT levering, bsn, onr, 'B' || levering, vnr, verzonden, cast(l_quantity AS varchar), pid, 'TBGI'
FROM l""",
    "detail_bekostiging_parent": f"""WITH {L}
SELECT levering, {PERSON}, 'B' || levering AS "BRIN", {VNR}, dag AS "Teldatum",
  substr(o_orderpriority, 1, 1) AS "BBLBOLFactor", {PID}, 'BII' AS _bron FROM o
UNION ALL
SELECT levering, bsn, onr, 'B' || levering, vnr, verzonden, cast(l_quantity AS varchar), pid, 'TBGI'
FROM l""",
    "xml_files": f"""WITH {L}, {XML_DATES}
SELECT levering, 'B' || levering AS "BRIN", {VNR}, cast(verzonden + nr AS date) AS "Teldatum",
  cast(l_partkey AS varchar) AS "Opleidingcode", l_quantity AS "BBLBOLFactor",
  cast(l_suppkey AS varchar) AS "BPV_Volgnummer" FROM t""",
    "landing_obt": f"""WITH {L}, {P}
SELECT 'levering=' || l.levering || '/RO_' || l.levering AS levering, l.pid AS _persoon_id, {VNR},
  verzonden AS "DatumBegin", cast(l_partkey AS varchar) AS "Opleidingcode", "Geboortedatum",
  count(*) OVER (PARTITION BY vnr) AS "BPV_Aantal",
  cast(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity END) OVER (PARTITION BY vnr), 0) AS double)
    AS "BPV_TotaalOmvang"
FROM l LEFT JOIN p ON l.levering = p.levering AND l.pid = p.pid""",
    "landing_twice": f"""WITH {L}, {P},
g AS (SELECT * FROM l WHERE levering != '1997' AND (levering != '1996' OR (l_orderkey * 8 + l_linenumber) % 2 = 0))
SELECT 'eerst/RO_' || g.levering AS levering, g.pid AS _persoon_id, {VNR}, verzonden AS "DatumBegin",
  cast(l_partkey AS varchar) AS "Opleidingcode", "Geboortedatum",
  (SELECT count(*) FROM g WHERE levering IN ('1996', '1998')) AS nieuw_geschreven
FROM g LEFT JOIN p ON g.levering = p.levering AND g.pid = p.pid""",
    "skewed_join": """SELECT 'L' AS levering, CASE WHEN l_orderkey % 10 = 0 THEN l_partkey ELSE -1 END AS sleutel,
  l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 10 = 0 THEN p_brand ELSE 'veel' END AS p_brand
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey""",
    "meta_leveringen": f"""WITH {O}, {VLP},
s AS (SELECT levering, count(*) AS "AantalISG", count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "AantalISE",
      count(*) FILTER (WHERE o_orderstatus = 'F') AS "AantalDIP" FROM o GROUP BY levering)
SELECT v.*, s.* EXCLUDE (levering) FROM v LEFT JOIN s ON v.levering = s.levering""",
    "tbgi_fallback": f"""WITH {O}
SELECT levering, {PERSON}, 'B' || levering AS "BRIN", {VNR}, dag AS "DatumInschrijving", {PID} FROM o""",
    "report_fundable": f"""WITH {L}
SELECT levering, count(*) AS aantal FROM l WHERE l_linestatus = 'O' GROUP BY levering""",
    "report_enrolment_rollup": f"""{WIDE} SELECT {KEY}, max("BPV_Aantal") AS "BPV_Aantal",
  max("BPV_TotaalOmvang") AS "BPV_TotaalOmvang" FROM w GROUP BY levering, pid, vnr""",
    "report_placement_hours": f"""WITH {L}
SELECT levering, cast(count(*) AS bigint) AS "BPV_Aantal", cast(sum({HOURS}) AS double) AS "BPV_TotaalOmvang",
  count(DISTINCT vnr) AS inschrijvingen FROM l GROUP BY levering""",
    "report_deliveries": f"""WITH {L} SELECT levering, count(*) AS rijen FROM l GROUP BY levering""",
}

SQL |= funding_sql(O, L)
