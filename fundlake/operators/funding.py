"""What an enrolment is worth on a count date: a product of factors that hold for a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.operators.intervals import valid_at

# Decimals of the factors and of the value, and the last day on which the residence factor counts.
FACTOR = "decimal(7,2)"
VALUE = "decimal(15,6)"
RESIDENCE_UNTIL = "2018-10-01"
# End of fixed values.


def participant_value(path: Column, price: Column, residence: Column, day: Column) -> Column:
    """Learning-path factor times price factor, times the residence factor up to the day it was abolished.

    Factors are decimals, so the product is exact; it is rounded once, half up, to the six decimals of the published value.
    A missing residence factor counts as 1, any other missing factor leaves the value null.
    """
    stays = F.when(day <= F.lit(RESIDENCE_UNTIL).cast("date"), F.coalesce(residence.cast(FACTOR), F.lit(1).cast(FACTOR))).otherwise(F.lit(1).cast(FACTOR))
    exact = path.cast(FACTOR) * price.cast(FACTOR) * stays
    return F.round(exact, 6).cast(VALUE)


def with_participant_value(count_dates: DataFrame, path_factors: DataFrame, price_factors: DataFrame) -> DataFrame:
    """``count_dates`` with BBLBOLFactor and PrijsfactorMBO as of their Teldatum, and Deelnemerswaarde.

    ``count_dates`` has Teldatum, Leertraject, Opleidingcode and, if known, Verblijfsjaarfactor; factors it has already are
    replaced. ``path_factors`` has Leertraject, van, tot, BBLBOLFactor and ``price_factors`` Opleidingcode, van, tot,
    PrijsfactorMBO; ``tot`` is the last day, null if open. The grain stays as it is.
    """
    rows = count_dates.drop("BBLBOLFactor", "PrijsfactorMBO")
    rows = valid_at(rows, path_factors, ["Leertraject"], "Teldatum", "van", "tot")
    rows = valid_at(rows, price_factors, ["Opleidingcode"], "Teldatum", "van", "tot")
    residence = F.col("Verblijfsjaarfactor") if "Verblijfsjaarfactor" in rows.columns else F.lit(None)
    value = participant_value(F.col("BBLBOLFactor"), F.col("PrijsfactorMBO"), residence, F.col("Teldatum"))
    return rows.withColumn("Deelnemerswaarde", value)
