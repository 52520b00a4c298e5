"""Declared totals against what was delivered."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.columns import LEVERING

# The totals record, the prefix of its fields, and the record types whose education codes are added up.
TOTALS = "SLR"
COUNT_PREFIX = "Aantal"
CODED = ("ISP", "BPV", "DIP")
FUNDABLE = ("ISP", "DIP")
YES = ("J", "1", "true")
# End of fixed values.

EXACT = "decimal(38,0)"


def declared_counts(totals: DataFrame) -> DataFrame:
    """A row per declared count: levering, recordtype, opgegeven. Columns beyond the counts are left out."""
    fields = [c for c in totals.columns if c.startswith(COUNT_PREFIX)]
    values = totals.select(LEVERING, *[F.col(c).cast("bigint").alias(c.removeprefix(COUNT_PREFIX)) for c in fields])
    return values.unpivot([LEVERING], [c.removeprefix(COUNT_PREFIX) for c in fields], "recordtype", "opgegeven").where(
        "opgegeven IS NOT NULL"
    )


def delivered_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per delivery and record type, counted where they are read."""
    counts = [
        df.groupBy(LEVERING).agg(F.count(F.lit(1)).alias("geteld")).select(LEVERING, F.lit(name).alias("recordtype"), "geteld")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def verdict(declared: Column, found: Column, allowed: Column) -> Column:
    return (
        F.when(declared.isNull(), "niet opgegeven")
        .when(F.abs(found - declared) <= allowed, "gelijk")
        .when(found < declared, "te weinig")
        .otherwise("te veel")
    )


def reconcile_counts(tables: dict[str, DataFrame], tolerance: str = "0") -> DataFrame:
    """Declared and delivered rows per delivery and record type: opgegeven, geteld, verschil, oordeel.

    A type that was declared and not delivered counts 0 rows. A type without a declaration is reported if it has rows.
    ``tolerance`` is the part of the declared number that may be off, as a decimal text.
    """
    counted = delivered_counts({name: df for name, df in tables.items() if name != TOTALS})
    # Several totals records of a delivery are a fault of their own; the largest declaration is compared.
    declared = declared_counts(tables[TOTALS]).groupBy(LEVERING, "recordtype").agg(F.max("opgegeven").alias("opgegeven"))
    both = declared.join(counted, [LEVERING, "recordtype"], "full").withColumn("geteld", F.coalesce("geteld", F.lit(0)))
    allowed = F.col("opgegeven").cast(EXACT) * F.lit(Decimal(tolerance))
    return both.select(
        LEVERING, "recordtype", "opgegeven", "geteld", (F.col("geteld") - F.col("opgegeven")).alias("verschil"),
        verdict(F.col("opgegeven"), F.col("geteld"), allowed).alias("oordeel"),
    )


def _control_rows(name: str, df: DataFrame) -> DataFrame:
    """What a record adds to the control totals. Codes are added as whole numbers; others are counted as invalid."""
    code = F.col("Opleidingcode").cast("string") if name in CODED and "Opleidingcode" in df.columns else F.lit(None).cast("string")
    number = F.when(code.rlike(r"^[0-9]{1,18}$"), code.cast(EXACT))
    fundable = F.col("IndicatieBekostigbaar").isin(*YES) if name in FUNDABLE and "IndicatieBekostigbaar" in df.columns else F.lit(False)
    return df.select(
        LEVERING, F.lit(name).alias("recordtype"), number.alias("code"), (code.isNotNull() & number.isNull()).alias("ongeldig"),
        F.coalesce(fundable, F.lit(False)).alias("bekostigbaar"),
    )


def control_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Control totals per delivery and record type, per delivery, and over all, in one aggregate by grouping sets.

    niveau (recordtype, levering, alles), levering, recordtype, records, opleidingcodes (sum of the codes as numbers),
    ongeldige_codes, bekostigbaar, totaal_generaal (codes + ISG + fundable + DIP).
    """
    rows = reduce(DataFrame.unionAll, [_control_rows(name, tables[name]) for name in ("ISG", *CODED) if name in tables])
    counted = F.count_if(F.col("recordtype").isin("ISG", "DIP")).cast(EXACT)
    totals = rows.groupingSets([[LEVERING, "recordtype"], [LEVERING], []], LEVERING, "recordtype").agg(
        F.grouping_id().alias("_niveau"),
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum("code"), F.lit(0).cast(EXACT)).cast(EXACT).alias("opleidingcodes"),
        F.count_if("ongeldig").alias("ongeldige_codes"),
        F.count_if("bekostigbaar").alias("bekostigbaar"),
        counted.alias("_geteld"),
    )
    level = F.when(F.col("_niveau") == 0, "recordtype").when(F.col("_niveau") == 1, "levering").otherwise("alles")
    whole = (F.col("opleidingcodes") + F.col("_geteld") + F.col("bekostigbaar").cast(EXACT)).cast(EXACT)
    return totals.select(
        level.alias("niveau"), LEVERING, "recordtype", "records", "opleidingcodes", "ongeldige_codes", "bekostigbaar", whole.alias("totaal_generaal")
    )


def reconcile_totals(found: DataFrame, declared: DataFrame, tolerance: str = "0") -> DataFrame:
    """Grand totals of deliveries against declared ones (levering, totaal_opgegeven): verschil and oordeel."""
    per_delivery = found.where("niveau = 'levering'").select(LEVERING, "totaal_generaal")
    both = declared.select(LEVERING, F.col("totaal_opgegeven").cast(EXACT)).join(per_delivery, LEVERING, "full")
    total = F.coalesce("totaal_generaal", F.lit(0).cast(EXACT))
    allowed = F.col("totaal_opgegeven") * F.lit(Decimal(tolerance))
    return both.select(
        LEVERING, "totaal_opgegeven", total.alias("totaal_generaal"), (total - F.col("totaal_opgegeven")).cast(EXACT).alias("verschil"),
        verdict(F.col("totaal_opgegeven"), total, allowed).alias("oordeel"),
    )
