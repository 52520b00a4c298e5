"""Questions asked of the written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.columns import LEVERING
from fundlake.operators.keys import ENROLMENT_KEY
from fundlake.operators.reconcile import TOTALS, control_totals, reconcile_counts
from fundlake.operators.union import tagged_union
from fundlake.sources.discovery import discover
from fundlake.sources.exports import table_path
from fundlake.sources.filenames import named_deliveries, superseded
from fundlake.sources.prepared import read_store

PREVIEW_ROWS = 1_000
PLACEMENT_COLUMNS = ("BPV_Aantal", "BPV_TotaalOmvang")


def run_summary(counts: dict[str, int]) -> dict[str, int]:
    """Tables and total rows of a run, from the counts taken while writing."""
    return {"tabellen": len(counts), "rijen": sum(counts.values())}


def delivery_names(obt: DataFrame) -> DataFrame:
    return obt.select(LEVERING).distinct().orderBy(LEVERING)


def delivery_counts(obt: DataFrame) -> DataFrame:
    """Rows per delivery."""
    return obt.groupBy(LEVERING).agg(F.count(F.lit(1)).alias("rijen"))


def obt_summary(spark: SparkSession, output: str, counts: dict[str, int]) -> dict:
    """Row counts of the main tables and the sorted deliveries, one line each on the driver."""
    obt = spark.read.parquet(table_path(output, "obt_inschrijvingen"))
    return {
        "isp_rijen": counts["obt_inschrijvingen"],
        "bekostiging_rijen": counts["detail_bekostiging"],
        "bpv_rijen": counts["detail_bpv"],
        "kzd_amo_rijen": counts["detail_kzd_amo"],
        "leveringen": delivery_names(obt),
    }


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> tuple[int, int, DataFrame]:
    """Row count, column count and the first rows of a table."""
    return df.count(), len(df.columns), df.limit(rows)


def fundable_per_delivery(obt: DataFrame, codes: Sequence[str] = ("J",)) -> DataFrame:
    """Fundable periods per delivery. One family writes ``J``, the other ``1``."""
    return (
        obt.where(F.col("IndicatieBekostigbaar").isin(*codes)).groupBy(LEVERING).agg(F.count(F.lit(1)).alias("aantal"))
    )


def enrolment_rollup(obt: DataFrame, columns: Sequence[str] = PLACEMENT_COLUMNS) -> DataFrame:
    """One row per enrolment. Its aggregates repeat on every period, so sums must start from here."""
    return obt.groupBy(*ENROLMENT_KEY).agg(*[F.max(c).alias(c) for c in columns])


def placement_hours(obt: DataFrame) -> DataFrame:
    """Placements and hours per delivery, each enrolment counted once."""
    return (
        enrolment_rollup(obt)
        .groupBy(LEVERING)
        .agg(*[F.sum(c).alias(c) for c in PLACEMENT_COLUMNS], F.count(F.lit(1)).alias("inschrijvingen"))
    )


def reconcile_store(spark: SparkSession, prepared: str, tolerance: str = "0") -> DataFrame:
    """Declared and delivered rows of every delivery in the stores of a landing zone, with their family in ``_bron``."""
    stores = {family: read_store(spark, prepared, family) for family in ("ro", "grondslag")}
    found = {family: reconcile_counts(tables, tolerance) for family, tables in stores.items() if TOTALS in tables}
    if not found:
        raise FileNotFoundError(f"Geen sluitrecords onder {prepared}")
    return tagged_union(found)


def store_totals(spark: SparkSession, prepared: str, family: str = "ro") -> DataFrame:
    """Control totals of a family's store, per record type, per delivery and over all."""
    return control_totals(read_store(spark, prepared, family))


def replaced_deliveries(spark: SparkSession, raw: str) -> DataFrame:
    """Deliveries under ``raw`` with the period in their name and the newer delivery that replaces them, if any."""
    return superseded(named_deliveries(discover(spark, raw)))
