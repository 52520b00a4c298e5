"""Person key and repair of enrolment references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.columns import LEVERING, PERSOON, VOLGORDE
from fundlake.operators.joins import first_per_key, left_join_all

# Person identifiers in order of preference and the keys built on them.
PERSON_COLUMNS = ("PseudoNummer", "Burgerservicenummer", "Onderwijsnummer")
PERSON_KEY = (LEVERING, PERSOON)
ENROLMENT_KEY = (LEVERING, PERSOON, "Inschrijvingvolgnummer")
DIPLOMA_REFERENCE = "ResultaatvolgnummerDiploma"
# End of fixed values.

_VIA_DIPLOMA = "_volgnummer_via_diploma"


def person_id(columns: list[str]) -> Column:
    """First filled identifier among the columns that exist; a null text when there is none."""
    present = [F.col(c) for c in PERSON_COLUMNS if c in columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def with_person_id(df: DataFrame) -> DataFrame:
    return df.withColumn(PERSOON, person_id(df.columns))


def fk_repair(df: DataFrame, diplomas: DataFrame | None, dedup: bool = False, **limits: int) -> DataFrame:
    """Fill a blank ``Inschrijvingvolgnummer`` through the diploma a result refers to; a filled one stays.

    A diploma reference that occurs more than once in ``diplomas`` multiplies the rows, unless ``dedup`` takes the
    first one only.
    """
    df = df.withColumn("Inschrijvingvolgnummer", F.nullif("Inschrijvingvolgnummer", F.lit("")))
    if diplomas is None or DIPLOMA_REFERENCE not in df.columns:
        return df
    on = [*PERSON_KEY, DIPLOMA_REFERENCE]
    keys = with_person_id(diplomas).select(
        *PERSON_KEY,
        F.col("Resultaatvolgnummer").alias(DIPLOMA_REFERENCE),
        F.col("Inschrijvingvolgnummer").alias(_VIA_DIPLOMA),
        *([VOLGORDE] if dedup else []),
    )
    if dedup:
        keys = first_per_key(keys, on)
    joined = left_join_all(df, [keys], on, **limits)
    repaired = F.coalesce("Inschrijvingvolgnummer", _VIA_DIPLOMA)
    return joined.withColumn("Inschrijvingvolgnummer", repaired).select(*df.columns)
