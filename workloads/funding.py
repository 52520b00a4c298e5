"""Queries about declared totals, factors that hold for a time, code lists and the names of deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.codes import code_dictionary, decode_codes, harmonise
from fundlake.operators.funding import with_participant_value
from fundlake.operators.intervals import split_by_study_year
from fundlake.operators.reconcile import control_totals, reconcile_counts, reconcile_totals
from fundlake.operators.union import tagged_union
from fundlake.sources.exports import visible
from fundlake.sources.filenames import named_deliveries, superseded
from workloads import tables as T

LEARNING_PATH = "CASE l_returnflag WHEN 'A' THEN 'BOL' WHEN 'N' THEN 'BBL' ELSE 'BOL_DT' END"


def slr_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Declared counts against rows. Every third year declares an enrolment too many and leaves the diplomas out; 1997 has
    no support periods and 1996 declares no enrolment."""
    src = T.Source(spark, sf)
    year = "cast(levering AS int)"
    declared = T.slr(src).selectExpr(
        "levering", f"IF({year} = 1996, NULL, AantalISG + IF({year} % 3 = 0, 1, 0)) AS AantalISG", "AantalISE",
        f"IF({year} % 3 = 0, NULL, AantalDIP) AS AantalDIP", "0L AS AantalAMO",
    )
    tables = {"ISG": T.isg(src), "ISE": T.ise(src).where("levering != '1997'"), "DIP": T.dip(src), "SLR": declared}
    return reconcile_counts(tables, tolerance="0.001")


def _coded(src: T.Source) -> dict[str, DataFrame]:
    diplomas = T.dip(src).withColumn("IndicatieBekostigbaar", F.when(F.col("Opleidingcode") < "3", "J").otherwise("N"))
    return {"ISG": T.isg(src), "ISP": T.isp(src), "BPV": T.bpv(src), "DIP": diplomas}


def control_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Control totals at three levels in one pass; codes of diplomas are no numbers."""
    return control_totals(_coded(T.Source(spark, sf)))


def control_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Grand totals against a declaration that is off by a tenth of a percent of the enrolments."""
    src = T.Source(spark, sf)
    declared = src.lines.groupBy("levering").agg(F.sum("l_partkey").cast("decimal(38,0)").alias("totaal_opgegeven"))
    return reconcile_totals(control_totals(_coded(src)), declared, tolerance="0.01")


def participant_values(spark: SparkSession, sf: str) -> DataFrame:
    """The value of every line item as a count date, with price factors per part and period that overlap and leave gaps."""
    src = T.Source(spark, sf)
    dates = src.lines.selectExpr(
        "levering", "l_orderkey", "l_linenumber", "date_add(verzonden, IF(l_linenumber < 4, 0, 8000)) AS Teldatum", "cast(l_partkey AS string) AS Opleidingcode",
        f"{LEARNING_PATH} AS Leertraject", "l_tax AS Verblijfsjaarfactor", "l_quantity AS BBLBOLFactor", "l_extendedprice",
    )
    paths = spark.sql(
        "SELECT * FROM VALUES ('BOL', DATE'1990-01-01', NULL, 1.00), ('BBL', DATE'1990-01-01', DATE'1997-07-31', 0.40), "
        "('BBL', DATE'1997-08-01', CAST(NULL AS DATE), 0.50), ('BOL_DT', DATE'1990-01-01', DATE'1999-12-31', 0.60) "
        "AS t(Leertraject, van, tot, BBLBOLFactor)"
    )
    part = T.table(spark, sf, "part")
    price = "cast((p_size + 50) * 0.01 AS decimal(7,2))"
    early = part.selectExpr("cast(p_partkey AS string) AS Opleidingcode", "DATE'1990-01-01' AS van", "DATE'1998-12-31' AS tot", f"{price} AS PrijsfactorMBO")
    late = part.where("p_partkey % 3 != 0").selectExpr(
        "cast(p_partkey AS string) AS Opleidingcode", "DATE'1998-01-01' AS van", "CAST(NULL AS DATE) AS tot", f"cast({price} + 1 AS decimal(7,2)) AS PrijsfactorMBO"
    )
    valued = with_participant_value(dates, paths, early.unionAll(late))
    return valued.select(
        "levering", "l_orderkey", "l_linenumber", "l_extendedprice", "Leertraject", "Teldatum", F.col("BBLBOLFactor").cast("double").alias("bbl"),
        F.col("PrijsfactorMBO").cast("double").alias("prijs"), F.col("Deelnemerswaarde").cast("double").alias("waarde"),
    )


def enrolment_years(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each study year that an order covers as an enrolment; every ninth is open, every eleventh ends too early."""
    orders = T.Source(spark, sf).orders.selectExpr(
        "levering", "o_orderkey", "dag AS begin",
        "CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN date_add(dag, -1) ELSE date_add(dag, cast(o_orderkey % 1500 AS int)) END AS eind",
    )
    return split_by_study_year(orders, "begin", "eind", F.lit("2003-07-31").cast("date"))


def codes_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """Meaning and validity of codes on the day of each line item; some codes are blank, some in no list, some expired."""
    items = T.Source(spark, sf).lines.selectExpr(
        "levering", "l_orderkey", "l_linenumber", "l_extendedprice", "date_add(verzonden, 9000) AS dag",
        f"CASE WHEN l_linenumber = 7 THEN 'XX' WHEN l_linenumber = 6 THEN NULL ELSE {LEARNING_PATH} END AS Leertraject",
        "concat('0', l_linenumber) AS Reden", "IF(l_linestatus = 'O', 'DLP', 'dlp') AS Leerroute",
    )
    lists = {"Leertraject": "Leertraject", "Reden": "RedenUitschrijving", "Leerroute": "Leerroute"}
    return decode_codes(items, lists, "dag", code_dictionary(spark))


def delivery_names(spark: SparkSession, sf: str) -> DataFrame:
    """File names made from orders, decoded, and the newer delivery that replaces each."""
    day = "date_format(date_add(dag, {}), 'yyyyMMdd')"
    brin = "lpad(cast(o_custkey % 500 AS string), 4, '0')"
    name = (
        f"CASE o_orderkey % 4 WHEN 0 THEN concat('ro_', {brin}, '_', {day.format(0)}, '_', {day.format(300)}, '.v1.csv') "
        f"WHEN 1 THEN concat('TBGI_', {brin}, '_', year(dag) + 2, '_', {day.format(90)}, '.XML') "
        f"WHEN 2 THEN concat('GRONDSLAG_IP_MBO_', {brin}, '_', {day.format(30)}, '_', year(dag), '.csv') "
        f"ELSE concat('RO_', {brin}, '_19991301_20000101.csv') END"
    )
    files = T.Source(spark, sf).orders.selectExpr("lpad(cast(o_orderkey AS string), 12, '0') AS levering", f"concat('/raw/h1/', {name}) AS pad")
    return superseded(named_deliveries(files))


def harmonised_union(spark: SparkSession, sf: str) -> DataFrame:
    """Electives of two families in their own codings, in one coding after the union."""
    items = T.Source(spark, sf).lines
    own = items.selectExpr(
        "levering", "l_orderkey", "l_linenumber", "l_extendedprice", "IF(l_linestatus = 'O', 'J', 'N') AS Certificaat", "IF(l_returnflag = 'A', 'Behaald', 'Niet behaald') AS Resultaat"
    )
    other = items.selectExpr(
        "levering", "l_orderkey", "l_linenumber", "l_extendedprice",
        "CASE WHEN l_linenumber = 5 THEN '9' WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS Certificaat",
        "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_returnflag = 'A' THEN 'BEHAALD' ELSE 'NIET BEHAALD' END AS Resultaat",
    )
    parts = {"RO": harmonise({"KZD": own}, "ro")["KZD"], "GRONDSLAG": harmonise({"KZD": other}, "grondslag")["KZD"]}
    return visible(tagged_union(parts))


FUNDING = {
    f.__name__: f
    for f in (
        slr_reconcile, control_sums, control_verdict, participant_values, enrolment_years, codes_decoded, delivery_names, harmonised_union,
    )
}
