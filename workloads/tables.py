"""The given tables presented as deliveries.

A delivery is an order year, a person a customer, an enrolment an order and an enrolment period a line item. Every
table is a projection of orders, of line items joined with their order, or a per-year aggregate.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.columns import OUDER_PREFIX, VOLGORDE
from fundlake.session import begin_with, first_partitions, work_table

# Full position of a line item: the key alone is not unique.
LINE_POSITION = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)
RESULTS = {"A": "Behaald", "N": "Niet behaald", "R": "BEHAALD"}

#: Line items, with the lines of text or the records made of them, that a task takes where a table is dealt.
ROWS_PER_TASK = 200_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Rows dealt by key: a given table is one file of one row group, which would be rendered by one task.

    ``rows`` are those that come of it. The parts grow with them, so that what a task sorts, joins or renders does not.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, key) if parts > least else df.repartition(key)


class Source:
    """Orders and line items of one folder.

    ``staged`` writes the joined line items once, as the prepared tables of a landing zone would be; without it every
    use reads and joins the given files.
    """

    def __init__(self, spark: SparkSession, sf: str, staged: bool = False):
        self.spark, self.sf, self.staged = spark, sf, staged

    @cached_property
    def rows(self) -> int:
        """Line items, which the file tells without reading them. Orders are dealt alike, so the join finds both in place."""
        rows = table(self.spark, self.sf, "lineitem").count()
        begin_with(self.spark, first_partitions(self.spark, rows, ROWS_PER_TASK))
        return rows

    @cached_property
    def orders(self) -> DataFrame:
        """Orders with delivery, person and enrolment keys. Every fifth customer is known by another number."""
        return spread(table(self.spark, self.sf, "orders"), "o_orderkey", self.rows).selectExpr(
            "*",
            "cast(year(o_orderdate) AS string) AS levering",
            "CASE WHEN o_custkey % 5 != 0 THEN cast(o_custkey AS string) END AS Burgerservicenummer",
            "CASE WHEN o_custkey % 5 = 0 THEN concat('ON', o_custkey) END AS Onderwijsnummer",
            "cast(o_orderkey AS string) AS Inschrijvingvolgnummer",
            "cast(o_orderdate AS date) AS dag",
            f"struct(o_orderkey AS blok) AS {VOLGORDE}",
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with the keys of their order."""
        keys = self.orders.select(
            F.col("o_orderkey").alias("l_orderkey"),
            "levering",
            "Burgerservicenummer",
            "Onderwijsnummer",
            "Inschrijvingvolgnummer",
        )
        items = spread(table(self.spark, self.sf, "lineitem"), "l_orderkey", self.rows)
        joined = items.withColumn("verzonden", F.col("l_shipdate").cast("date")).join(keys, "l_orderkey")
        lines = work_table(joined, "regels-per-order") if self.staged else joined
        return lines.withColumn(VOLGORDE, F.struct(*LINE_POSITION))


KEYS = ("levering", "Burgerservicenummer", "Onderwijsnummer")


def isp(src: Source) -> DataFrame:
    return src.lines.selectExpr(
        *KEYS,
        "'ISP' AS Recordsoort",
        "Inschrijvingvolgnummer",
        "verzonden AS DatumBegin",
        "cast(l_partkey AS string) AS Opleidingcode",
        "l_returnflag AS Leertraject",
        "l_linestatus AS Niveau",
        "CASE WHEN l_linestatus = 'O' THEN 'J' ELSE 'N' END AS IndicatieBekostigbaar",
        "cast(l_suppkey AS string) AS Onderwijsaanbieder",
        "cast(l_linenumber AS string) AS Leerroute",
        VOLGORDE,
    )


def per(src: Source) -> DataFrame:
    """A person row per order, so a person has several and the first counts."""
    return src.orders.selectExpr(
        *KEYS, "'PER' AS Recordsoort", "dag AS Geboortedatum", "o_orderstatus AS Geslacht", VOLGORDE
    )


def isg(src: Source) -> DataFrame:
    return src.orders.selectExpr(
        *KEYS,
        "'ISG' AS Recordsoort",
        "Inschrijvingvolgnummer",
        "dag AS DatumInschrijving",
        "date_add(dag, 365) AS DatumUitschrijvingGepland",
        "CASE WHEN o_orderstatus = 'F' THEN date_add(dag, 90) END AS DatumUitschrijvingWerkelijk",
        "o_orderpriority AS RedenUitschrijving",
        VOLGORDE,
    )


def ise(src: Source) -> DataFrame:
    return (
        src.orders
        .where("o_orderpriority = '1-URGENT'")
        .selectExpr(
            *KEYS,
            "'ISE' AS Recordsoort",
            "Inschrijvingvolgnummer",
            "dag AS DatumBegin",
            "date_add(dag, 30) AS DatumEind",
            VOLGORDE,
        )
    )


def dip(src: Source) -> DataFrame:
    return (
        src.orders
        .where("o_orderstatus = 'F'")
        .selectExpr(
            *KEYS,
            "'DIP' AS Recordsoort",
            "concat('R', o_orderkey) AS Resultaatvolgnummer",
            "o_orderpriority AS Opleidingcode",
            "date_add(dag, 60) AS DatumResultaat",
            "cast(NULL AS string) AS _onbekend",
            "'J' AS IndicatieBekostigbaar",
            "Inschrijvingvolgnummer",
            VOLGORDE,
        )
    )


def bpv(src: Source) -> DataFrame:
    return src.lines.selectExpr(
        *KEYS,
        "'BPV' AS Recordsoort",
        "Inschrijvingvolgnummer",
        "cast(l_linenumber AS string) AS Volgnummer",
        "verzonden AS DatumBegin",
        "CASE WHEN l_linestatus = 'F' THEN date_add(verzonden, 10) END AS DatumEindWerkelijk",
        "CASE WHEN l_orderkey % 7 != 0 THEN cast(l_quantity AS bigint) END AS Omvang",
        VOLGORDE,
    )


# Results carry their own enrolment number unless finished; then only the diploma leads to it.
_RESULT_KEYS = (
    *KEYS,
    "concat('R', l_orderkey) AS ResultaatvolgnummerDiploma",
    "CASE WHEN l_linestatus = 'F' THEN '' ELSE Inschrijvingvolgnummer END AS Inschrijvingvolgnummer",
)


def _rounded(number: str) -> str:
    """SQL of a number rounded half away from zero, as ``round`` does by way of decimals of any size, which costs more."""
    whole = f"cast({number} AS bigint)"
    return f"{whole} + cast(2 * ({number} - {whole}) AS bigint)"


def geo(src: Source) -> DataFrame:
    return src.lines.selectExpr(
        *_RESULT_KEYS,
        "'GEO' AS Recordsoort",
        "cast(3000 + l_linenumber AS string) AS CodeGeneriekExamenonderdeel",
        "cast(l_quantity AS bigint) AS Eindcijfer",
        "CASE WHEN l_returnflag != 'N' THEN l_returnflag END AS VrijstellingGeneriekExamenonderdeel",
        f"{_rounded('l_discount * 100')} AS CijferIE",
        f"{_rounded('l_tax * 100')} AS CijferCE",
        VOLGORDE,
    )


def kzd(src: Source) -> DataFrame:
    outcome = " ".join(f"WHEN '{flag}' THEN '{text}'" for flag, text in RESULTS.items())
    return src.lines.selectExpr(
        *_RESULT_KEYS,
        "'KZD' AS Recordsoort",
        "concat('K', l_partkey) AS CodeKeuzedeel",
        f"CASE l_linenumber WHEN 4 THEN NULL WHEN 5 THEN 'Vrijgesteld' ELSE CASE l_returnflag {outcome} END END AS Resultaat",
        VOLGORDE,
    )


def amo(src: Source) -> DataFrame:
    return src.lines.selectExpr(
        *_RESULT_KEYS, "'AMO' AS Recordsoort", "concat('C', l_suppkey) AS CodeAMvBOnderdeel", VOLGORDE
    )


def vlp(src: Source) -> DataFrame:
    return (
        src.orders
        .groupBy("levering")
        .agg(F.min("dag").alias("begin"), F.max("dag").alias("eind"))
        .selectExpr(
            "levering",
            "'VLP' AS Recordsoort",
            "concat('B', levering) AS BRIN",
            "begin AS DatumBeginPeriode",
            "eind AS DatumEindePeriode",
            "date_add(eind, 1) AS DatumAanmaak",
            f"struct(0L AS blok) AS {VOLGORDE}",
        )
    )


def slr(src: Source) -> DataFrame:
    return (
        src.orders
        .groupBy("levering")
        .agg(
            F.count(F.lit(1)).alias("AantalISG"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("AantalISE"),
            F.count_if(F.col("o_orderstatus") == "F").alias("AantalDIP"),
        )
        .withColumn("Recordsoort", F.lit("SLR"))
        .withColumn(VOLGORDE, F.expr("struct(0L AS blok)"))
    )


def bii(src: Source) -> DataFrame:
    """Funding basis with its factors as text."""
    return src.orders.selectExpr(
        *KEYS,
        "'BII' AS Recordsoort",
        "concat('B', levering) AS BRIN",
        "Inschrijvingvolgnummer",
        "dag AS Teldatum",
        "substr(o_orderpriority, 1, 1) AS BBLBOLFactor",
        VOLGORDE,
    )


def inschrijving(src: Source) -> DataFrame:
    return src.orders.selectExpr(
        *KEYS,
        "concat('B', levering) AS BRIN",
        "Inschrijvingvolgnummer",
        "dag AS DatumInschrijving",
        VOLGORDE,
    )


def teldatum(src: Source) -> DataFrame:
    """Count dates with a numeric factor and the person of their parent element."""
    return src.lines.selectExpr(
        "levering",
        "concat('B', levering) AS BRIN",
        "Inschrijvingvolgnummer",
        "verzonden AS Teldatum",
        "l_quantity AS BBLBOLFactor",
        f"Burgerservicenummer AS {OUDER_PREFIX}Burgerservicenummer",
        f"Onderwijsnummer AS {OUDER_PREFIX}Onderwijsnummer",
        VOLGORDE,
    )


LINE_TABLES = {"ISP", "GEO", "BPV", "KZD", "AMO", "Teldatum"}
PERIOD_TABLES = {"ISP": isp, "PER": per, "ISG": isg, "VLP": vlp}
ALL_TABLES = {
    **PERIOD_TABLES,
    "ISE": ise,
    "DIP": dip,
    "GEO": geo,
    "BPV": bpv,
    "KZD": kzd,
    "AMO": amo,
    "SLR": slr,
    "BII": bii,
    "Inschrijving": inschrijving,
    "Teldatum": teldatum,
}


def stacked(src: Source, *names: str) -> dict[str, DataFrame]:
    """Stacked set of the named tables."""
    return {name: ALL_TABLES[name](src) for name in names}
