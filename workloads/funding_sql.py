"""The queries of ``workloads.funding`` as plain SQL."""

from __future__ import annotations

PATH = "CASE l_returnflag WHEN 'A' THEN 'BOL' WHEN 'N' THEN 'BBL' ELSE 'BOL_DT' END"
STUDY_YEAR = "year({0}) - CASE WHEN month({0}) < 8 THEN 1 ELSE 0 END"


def funding_sql(orders: str, lines: str) -> dict[str, str]:
    """SQL per query, with the common tables ``o`` and ``l`` as given."""
    codes = f"""WITH {lines},
k AS (
  SELECT levering, 'ISG' AS soort, NULL::decimal(38,0) AS code, 0 AS ongeldig, 0 AS j FROM o
  UNION ALL SELECT levering, 'ISP', l_partkey::decimal(38,0), 0, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END FROM l
  UNION ALL SELECT levering, 'BPV', NULL, 0, 0 FROM l
  UNION ALL SELECT levering, 'DIP', NULL, 1, CASE WHEN o_orderpriority < '3' THEN 1 ELSE 0 END FROM o WHERE o_orderstatus = 'F'),
t AS (
  SELECT grouping(levering) AS gl, grouping(soort) AS gs, levering, soort, count(*) AS records, coalesce(sum(code), 0)::decimal(38,0) AS opleidingcodes,
    sum(ongeldig)::bigint AS ongeldige_codes, sum(j)::bigint AS bekostigbaar, count(*) FILTER (soort IN ('ISG', 'DIP')) AS geteld
  FROM k GROUP BY GROUPING SETS ((levering, soort), (levering), ())),
c AS (
  SELECT CASE WHEN gl = 1 THEN 'alles' WHEN gs = 1 THEN 'levering' ELSE 'recordtype' END AS niveau, levering, soort AS recordtype, records,
    opleidingcodes, ongeldige_codes, bekostigbaar, (opleidingcodes + geteld + bekostigbaar)::decimal(38,0) AS totaal_generaal FROM t)"""
    return {
        "slr_reconcile": f"""WITH {orders},
c AS (
  SELECT levering, 'ISG' AS recordtype, count(*) AS geteld FROM o GROUP BY levering
  UNION ALL SELECT levering, 'ISE', count(*) FROM o WHERE o_orderpriority = '1-URGENT' AND levering != '1997' GROUP BY levering
  UNION ALL SELECT levering, 'DIP', count(*) FROM o WHERE o_orderstatus = 'F' GROUP BY levering),
y AS (
  SELECT levering, levering::int AS jaar, count(*) AS isg, count(*) FILTER (o_orderpriority = '1-URGENT') AS ise,
    count(*) FILTER (o_orderstatus = 'F') AS dip FROM o GROUP BY levering),
d AS (
  SELECT levering, 'ISG' AS recordtype, isg + CASE WHEN jaar % 3 = 0 THEN 1 ELSE 0 END AS opgegeven FROM y WHERE jaar != 1996
  UNION ALL SELECT levering, 'ISE', ise FROM y
  UNION ALL SELECT levering, 'DIP', dip FROM y WHERE jaar % 3 != 0
  UNION ALL SELECT levering, 'AMO', 0 FROM y),
b AS (
  SELECT coalesce(d.levering, c.levering) AS levering, coalesce(d.recordtype, c.recordtype) AS recordtype, opgegeven,
    coalesce(geteld, 0) AS geteld FROM d FULL JOIN c ON d.levering = c.levering AND d.recordtype = c.recordtype)
SELECT levering, recordtype, opgegeven, geteld, geteld - opgegeven AS verschil,
  CASE WHEN opgegeven IS NULL THEN 'niet opgegeven' WHEN abs(geteld - opgegeven) <= opgegeven * 0.001 THEN 'gelijk'
    WHEN geteld < opgegeven THEN 'te weinig' ELSE 'te veel' END AS oordeel FROM b""",
        "control_sums": f"{codes} SELECT * FROM c",
        "control_verdict": f"""{codes},
d AS (SELECT levering, sum(l_partkey)::decimal(38,0) AS totaal_opgegeven FROM l GROUP BY levering),
f AS (SELECT levering, totaal_generaal FROM c WHERE niveau = 'levering'),
b AS (
  SELECT coalesce(d.levering, f.levering) AS levering, totaal_opgegeven, coalesce(totaal_generaal, 0)::decimal(38,0) AS totaal_generaal
  FROM d FULL JOIN f ON d.levering = f.levering)
SELECT *, (totaal_generaal - totaal_opgegeven)::decimal(38,0) AS verschil,
  CASE WHEN totaal_opgegeven IS NULL THEN 'niet opgegeven' WHEN abs(totaal_generaal - totaal_opgegeven) * 100 <= totaal_opgegeven THEN 'gelijk'
    WHEN totaal_generaal < totaal_opgegeven THEN 'te weinig' ELSE 'te veel' END AS oordeel FROM b""",
        "participant_values": f"""WITH {lines},
r AS (SELECT *, (verzonden + CASE WHEN l_linenumber < 4 THEN 0 ELSE 8000 END)::date AS dag, {PATH} AS pad FROM l),
f AS (
  SELECT r.*, CASE WHEN pad = 'BOL' THEN 1.00 WHEN pad = 'BBL' AND dag <= DATE '1997-07-31' THEN 0.40 WHEN pad = 'BBL' THEN 0.50
      WHEN dag <= DATE '1999-12-31' THEN 0.60 END::decimal(7,2) AS bbl,
    CASE WHEN l_partkey % 3 != 0 AND dag >= DATE '1998-01-01' THEN (p_size + 50) * 0.01 + 1
      WHEN dag <= DATE '1998-12-31' THEN (p_size + 50) * 0.01 END::decimal(7,2) AS prijs,
    CASE WHEN dag <= DATE '2018-10-01' THEN l_tax::decimal(7,2) ELSE 1::decimal(7,2) END AS verblijf
  FROM r LEFT JOIN part ON p_partkey = l_partkey)
SELECT levering, l_orderkey, l_linenumber, l_extendedprice, pad AS "Leertraject", dag AS "Teldatum", bbl::double AS bbl, prijs::double AS prijs,
  (bbl * prijs * verblijf)::decimal(15,6)::double AS waarde FROM f""",
        "enrolment_years": f"""WITH {orders},
p AS (
  SELECT levering, o_orderkey, dag AS "begin", CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN (dag - 1)::date
    ELSE (dag + (o_orderkey % 1500)::int)::date END AS eind FROM o),
q AS (SELECT *, least(coalesce(eind, DATE '2003-07-31'), DATE '2003-07-31') AS einde FROM p),
s AS (
  SELECT q.*, unnest(range({STUDY_YEAR.format('"begin"')}, {STUDY_YEAR.format("einde")} + 1)) AS jaar FROM q WHERE "begin" <= einde)
SELECT levering, o_orderkey, "begin", eind, jaar::int AS studiejaar, (jaar + 2)::int AS bekostigingsjaar,
  greatest("begin", make_date(jaar::int, 8, 1)) AS van, least(einde, make_date(jaar::int + 1, 7, 31)) AS tot,
  (datediff('day', greatest("begin", make_date(jaar::int, 8, 1)), least(einde, make_date(jaar::int + 1, 7, 31))) + 1)::int AS dagen FROM s""",
        "codes_decoded": f"""WITH {lines},
r AS (
  SELECT levering, l_orderkey, l_linenumber, l_extendedprice, (verzonden + 9000)::date AS dag,
    CASE WHEN l_linenumber = 7 THEN 'XX' WHEN l_linenumber = 6 THEN NULL ELSE {PATH} END AS "Leertraject",
    '0' || l_linenumber AS "Reden", CASE WHEN l_linestatus = 'O' THEN 'DLP' ELSE 'dlp' END AS "Leerroute" FROM l),
m AS (
  SELECT *, CASE "Leertraject" WHEN 'BOL' THEN 'Beroepsopleidende leerweg' WHEN 'BBL' THEN 'Beroepsbegeleidende leerweg'
      WHEN 'BOL_DT' THEN CASE WHEN dag <= DATE '2023-07-31' THEN 'Beroepsopleidende leerweg in deeltijd' END END AS "Leertraject_betekenis",
    CASE l_linenumber WHEN 1 THEN 'Geslaagd / diploma behaald' WHEN 2 THEN 'Eigen verzoek' WHEN 3 THEN 'Overplaatsing naar andere instelling'
      WHEN 4 THEN 'Niet meer verschenen' WHEN 5 THEN 'Overlijden' WHEN 6 THEN 'Andere reden' WHEN 7 THEN 'Verwijdering' END AS "Reden_betekenis",
    CASE WHEN "Leerroute" = 'DLP' AND dag >= DATE '2020-08-01' THEN 'Doorlopende leerroute vmbo–mbo' END AS "Leerroute_betekenis" FROM r)
SELECT *, CASE WHEN "Leertraject" IS NULL THEN NULL WHEN "Leertraject_betekenis" IS NOT NULL THEN 'geldig'
    WHEN "Leertraject" = 'XX' THEN 'onbekend' ELSE 'verlopen' END AS "Leertraject_status", 'geldig' AS "Reden_status",
  CASE WHEN "Leerroute" = 'dlp' THEN 'onbekend' WHEN "Leerroute_betekenis" IS NULL THEN 'verlopen' ELSE 'geldig' END AS "Leerroute_status" FROM m""",
        "delivery_names": f"""WITH {orders},
r AS (SELECT *, lpad((o_custkey % 500)::varchar, 4, '0') AS brin, (o_orderkey % 4)::int AS soort, lpad(o_orderkey::varchar, 12, '0') AS lev FROM o),
n AS (
  SELECT lev AS levering, '/raw/h1/' || CASE soort
      WHEN 0 THEN 'ro_' || brin || '_' || strftime(dag, '%Y%m%d') || '_' || strftime(dag + 300, '%Y%m%d') || '.v1.csv'
      WHEN 1 THEN 'TBGI_' || brin || '_' || (year(dag) + 2) || '_' || strftime(dag + 90, '%Y%m%d') || '.XML'
      WHEN 2 THEN 'GRONDSLAG_IP_MBO_' || brin || '_' || strftime(dag + 30, '%Y%m%d') || '_' || year(dag) || '.csv'
      ELSE 'RO_' || brin || '_19991301_20000101.csv' END AS pad,
    CASE soort WHEN 1 THEN 'tbgi' WHEN 2 THEN 'grondslag' ELSE 'ro' END AS bestandstype, brin,
    CASE soort WHEN 0 THEN dag WHEN 1 THEN make_date(year(dag)::int, 8, 1) WHEN 2 THEN make_date(year(dag)::int, 8, 1) END AS "begin",
    CASE soort WHEN 0 THEN (dag + 300)::date WHEN 3 THEN DATE '2000-01-01' ELSE make_date(year(dag)::int + 1, 7, 31) END AS eind,
    CASE soort WHEN 1 THEN (dag + 90)::date WHEN 2 THEN (dag + 30)::date END AS aanmaak,
    CASE WHEN soort = 1 THEN (year(dag) + 2)::int END AS bekostigingsjaar, CASE WHEN soort = 2 THEN year(dag)::int END AS studiejaar FROM r),
k AS (SELECT *, row_number() OVER (ORDER BY coalesce(aanmaak, DATE '0001-01-01'), eind, "begin", levering) AS leeftijd FROM n WHERE "begin" IS NOT NULL),
w AS (
  SELECT a.levering, arg_max(b.levering, b.leeftijd) AS vervangen_door FROM k a
  JOIN k b ON a.bestandstype = b.bestandstype AND a.brin = b.brin AND b.leeftijd > a.leeftijd AND b."begin" <= a.eind AND a."begin" <= b.eind GROUP BY 1)
SELECT n.*, vervangen_door FROM n LEFT JOIN w ON n.levering = w.levering""",
        "harmonised_union": f"""WITH {lines}
SELECT levering, l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_linestatus = 'O' THEN 'J' ELSE 'N' END AS "Certificaat",
  CASE WHEN l_returnflag = 'A' THEN 'Behaald' ELSE 'Niet behaald' END AS "Resultaat", 'RO' AS _bron FROM l
UNION ALL SELECT levering, l_orderkey, l_linenumber, l_extendedprice,
  CASE WHEN l_linenumber = 5 THEN '9' WHEN l_linestatus = 'O' THEN 'J' ELSE 'N' END,
  CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'Behaald' ELSE 'Niet behaald' END, 'GRONDSLAG' FROM l""",
    }
