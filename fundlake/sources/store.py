"""The store of a landing zone: a table per record type, partitioned by delivery, and the manifest of what was read.

A delivery is replaced as a whole and on its own: its partitions are overwritten, those that it no longer has are removed,
and no other delivery is touched. The manifest is written last, so a run that breaks off is taken up again by the next.
"""

from __future__ import annotations

from collections.abc import Collection
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundlake.columns import LEVERING
from fundlake.session import work_table
from fundlake.sources.discovery import whole_uri
from fundlake.sources.exports import table_path
from fundlake.sources.files import children, exists, loadable, remove

MANIFEST = "manifest"
SEEN = ("levering", "bestandstype", "pad", "bytes", "gewijzigd")
MANIFEST_SCHEMA = "levering string, bestandstype string, pad string, bytes long, gewijzigd timestamp, inhoud long"


def store_path(prepared: str, family: str) -> str:
    return f"{str(prepared).rstrip('/')}/{family}"


def read_manifest(spark: SparkSession, prepared: str) -> DataFrame:
    """Files of earlier runs, none before the first."""
    path = table_path(prepared, MANIFEST)
    if not exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def write_manifest(manifest: DataFrame, prepared: str) -> None:
    """Replace the manifest; ``manifest`` may be made from the one that is there."""
    held = work_table(manifest, MANIFEST)
    held.coalesce(1).write.mode("overwrite").parquet(table_path(prepared, MANIFEST))


def content_numbers(spark: SparkSession, files: DataFrame, line_sep: str) -> DataFrame:
    """``files`` with ``inhoud``, a number that depends on every row and its place. Files are read in splits."""
    paths = [row[0] for row in files.select(loadable(F.col("bron"))).collect()]
    if not paths:
        return files.withColumn("inhoud", F.lit(None).cast("long"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = spark.read.option("lineSep", line_sep).text(paths).select(
        whole_uri(F.col("_metadata.file_path")).alias("bron"), F.xxhash64("value", F.col("_metadata.file_block_start"), place).alias("rij")
    )
    numbers = rows.groupBy("bron").agg(F.bit_xor("rij").alias("inhoud"))
    return files.join(numbers, "bron", "left").withColumn("inhoud", F.coalesce("inhoud", F.lit(0)))


def write_deliveries(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Write the deliveries in ``tables`` over their own partitions; return rows per table."""
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"rijen {name}")
        counted = df.observe(seen, F.count(F.lit(1)).alias("rijen"))
        writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LEVERING)
        writer.parquet(table_path(folder, name))
        counts[name] = seen.get["rijen"]
    return counts


def stored_deliveries(spark: SparkSession, folder: str) -> set[str]:
    """Labels that have a partition in some table; there are as many as files."""
    tables = [name for name in children(spark, folder) if name.endswith(".parquet")] if exists(spark, folder) else []
    parts = {part for table in tables for part in children(spark, f"{folder}/{table}") if part.startswith(f"{LEVERING}=")}
    return {unquote(part.partition("=")[2]) for part in parts}


def drop_deliveries(spark: SparkSession, folder: str, gone: Collection[str], keep: dict[str, set[str]]) -> None:
    """Remove the partitions of the deliveries in ``gone`` but for those tables that ``keep`` names for a delivery.
    A table without partitions goes."""
    if not gone or not exists(spark, folder):
        return
    for table in [name for name in children(spark, folder) if name.endswith(".parquet")]:
        path = f"{folder}/{table}"
        parts = [name for name in children(spark, path) if name.startswith(f"{LEVERING}=")]
        label = {part: unquote(part.partition("=")[2]) for part in parts}
        stale = [part for part in parts if label[part] in gone and table.removesuffix(".parquet") not in keep.get(label[part], ())]
        for part in stale:
            remove(spark, f"{path}/{part}")
        if len(stale) == len(parts):
            remove(spark, path)
