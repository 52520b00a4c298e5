"""Code lists: what codes mean on a day, and one coding for all families."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundlake.operators.intervals import valid_at
from fundlake.operators.joins import lookup_join

DICTIONARY_SCHEMA = "lijst string, code string, betekenis string, geldig_van date, geldig_tot date"
BEFORE_ALL = date(1900, 1, 1)

# Published code lists as code, meaning, first and last day (none: always, or open).
CODE_LISTS: dict[str, list[tuple]] = {
    "Niveau": [
        ("MBO-1", "MBO Assistent / Entreeopleiding"),
        ("MBO-2", "MBO Basisberoepsopleiding"),
        ("MBO-3", "MBO Vakopleiding"),
        ("MBO-4", "MBO Middenkaderopleiding of Specialistenopleiding"),
    ],
    "Leertraject": [
        ("BOL", "Beroepsopleidende leerweg", date(1997, 8, 1)),
        ("BOL_DT", "Beroepsopleidende leerweg in deeltijd", date(1997, 8, 1), date(2023, 7, 31)),
        ("BBL", "Beroepsbegeleidende leerweg", date(1997, 8, 1)),
        ("OVO", "Overig onderwijs", date(1997, 8, 1)),
        ("EX", "Examendeelnemer", date(1997, 8, 1)),
        ("ODT", "Overig onderwijs niet-diploma gericht", date(2019, 1, 1)),
    ],
    "Leerroute": [("DLP", "Doorlopende leerroute vmbo–mbo", date(2020, 8, 1))],
    "Leerroutefase": [
        ("VO", "Het onderwijs wordt gevolgd in de VO-fase", date(2020, 8, 1)),
        ("MBO", "Het onderwijs wordt gevolgd in de MBO-fase", date(2020, 8, 1)),
    ],
    "Geslacht": [("M", "Man"), ("V", "Vrouw"), ("O", "Vastgesteld onbekend")],
    "RedenUitschrijving": [
        ("01", "Geslaagd / diploma behaald"),
        ("02", "Eigen verzoek"),
        ("03", "Overplaatsing naar andere instelling"),
        ("04", "Niet meer verschenen"),
        ("05", "Overlijden"),
        ("06", "Andere reden"),
        ("07", "Verwijdering"),
        ("08", "Administratief uitgeschreven"),
        ("09", "Verlies recht op bekostiging"),
        ("10", "Afgerond zonder diploma"),
    ],
    "StatusBepalingBekostigingsstatus": [
        ("V", "Voorlopig – berekening kan nog wijzigen"),
        ("D", "Definitief – bekostiging is vastgesteld"),
    ],
    "BekostigingsType": [("V", "Voorlopige bekostigingslevering"), ("D", "Definitieve bekostigingslevering")],
    "VrijstellingGeneriekExamenonderdeel": [
        ("MBO", "Vrijstelling op grond van eerder behaald MBO-diploma"),
        ("HBO", "Vrijstelling op grond van eerder behaald HBO-diploma"),
        ("VWO", "Vrijstelling op grond van eerder behaald VWO-diploma"),
        ("KZDL", "Vrijstelling op grond van keuzedelen landelijk"),
    ],
}
# Codings per family and column, to the coding of RO deliveries.
YES_NO = {"1": "J", "0": "N"}
TRUE_FALSE = {"true": "J", "false": "N"}
HARMONISED: dict[str, dict[tuple[str, str], dict[str, str]]] = {
    "grondslag": {
        ("ISP", "IndicatieBekostigbaar"): YES_NO,
        ("DIP", "IndicatieBekostigbaar"): YES_NO,
        ("KZD", "Certificaat"): YES_NO,
        ("AMO", "Certificaat"): YES_NO,
        ("KZD", "Resultaat"): {"BEHAALD": "Behaald", "NIET BEHAALD": "Niet behaald"},
    },
    "tbgi": {
        ("Teldatum", "IndicatieBekostigbaar"): TRUE_FALSE,
        ("Teldatum", "Bekostigingsstatus"): TRUE_FALSE,
        ("Teldatum", "InschrijvingVoorCorrectiefactor"): TRUE_FALSE,
    },
}
# End of fixed values.


def code_dictionary(spark: SparkSession, lists: Mapping[str, list[tuple]] = CODE_LISTS) -> DataFrame:
    """Code lists as rows: lijst, code, betekenis, geldig_van, geldig_tot. A code may occur with several validities."""
    rows = [
        (name, code, meaning, days[0] if days else BEFORE_ALL, days[1] if len(days) > 1 else None)
        for name, entries in lists.items()
        for code, meaning, *days in entries
    ]
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


def decode_codes(
    df: DataFrame, columns: Mapping[str, str], at: str, dictionary: DataFrame, seen: Observation | None = None
) -> DataFrame:
    """``df`` with ``<column>_betekenis`` and ``<column>_status`` for each column and the list it is coded by.

    The meaning is that on the day ``at``. Status: null for a blank code, ``geldig``, ``verlopen`` for a code that the list
    has for other days, ``onbekend`` for one that it does not have. ``seen`` counts the two latter per column while the
    rows are computed, so reporting them costs no pass of its own.
    """
    known = dictionary.select("lijst", F.col("code").alias("_code")).distinct()
    metrics = []
    for column, name in columns.items():
        entries = dictionary.where(F.col("lijst") == name).select(
            F.col("code").alias(column), F.col("betekenis").alias(f"{column}_betekenis"), "geldig_van", "geldig_tot"
        )
        listed = known.where(F.col("lijst") == name).select(F.col("_code").alias(column), F.lit(True).alias("_bekend"))
        df = valid_at(df, entries, [column], at, "geldig_van", "geldig_tot")
        df = lookup_join(df, listed, [column])
        status = (
            F.when(F.col(column).isNull(), F.lit(None).cast("string"))
            .when(F.col(f"{column}_betekenis").isNotNull(), "geldig")
            .when(F.col("_bekend"), "verlopen")
            .otherwise("onbekend")
        )
        df = df.withColumn(f"{column}_status", status).drop("_bekend")
        metrics += [F.count_if(F.col(f"{column}_status") == s).alias(f"{column}_{s}") for s in ("verlopen", "onbekend")]
    return df.observe(seen, *metrics) if seen is not None and metrics else df


def recoded(column: Column, codes: Mapping[str, str]) -> Column:
    """``column`` with the codes of one coding written in another; other values stay."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), column), column)


def harmonise(tables: dict[str, DataFrame], family: str) -> dict[str, DataFrame]:
    """Tables of a family in the coding of RO deliveries, so that a union of families has one coding per column."""
    rules = HARMONISED.get(family, {})

    def rewritten(name: str, df: DataFrame) -> DataFrame:
        mine = {column: codes for (table, column), codes in rules.items() if table == name and column in df.columns}
        return df.withColumns({column: recoded(F.col(column), codes) for column, codes in mine.items()}) if mine else df

    return {name: rewritten(name, df) for name, df in tables.items()}
