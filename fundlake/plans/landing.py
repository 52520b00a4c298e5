"""Everything under a landing folder in one run: one job per family, then the wide tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.columns import LEVERING
from fundlake.operators.decode import decode_frames
from fundlake.plans.normalise import read_family
from fundlake.plans.obt import ObtOptions, build_obt
from fundlake.plans.reports import obt_summary
from fundlake.schemas import SCHEMAS
from fundlake.session import FIRST_PARTITIONS, first_partitions, settings, work_area, work_table
from fundlake.sources.discovery import delivery_label, discover, family_glob, shared_labels
from fundlake.sources.exports import export_counted, table_path, write_table
from fundlake.sources.files import exists, loadable, remove
from fundlake.sources.prepared import stack_prepared, stack_store
from fundlake.sources.profile import STAGES
from fundlake.sources.store import (
    MANIFEST,
    SEEN,
    content_numbers,
    drop_deliveries,
    read_manifest,
    store_path,
    stored_deliveries,
    write_deliveries,
    write_manifest,
)

QUARANTINE = "quarantaine"
#: Rows of the largest table of a store for each partition that joins begin with.
ROWS_PER_TASK = 200_000


@dataclass
class LandingResult:
    """Rows written per family and table, rows of the wide tables, rejected deliveries and a summary."""

    prepared: dict[str, dict[str, int]]
    obt: dict[str, int]
    quarantine: DataFrame
    summary: dict


def normalise_family(
    spark: SparkSession, raw: str, prepared: str, family: str, files: DataFrame, shared: Sequence[str] = (), whole: bool = True
) -> tuple[dict[str, int], DataFrame]:
    """Type the deliveries in ``files`` into the store of their family; return rows per table and the rejected ones.

    A delivery is accepted or rejected as a whole, and replaces what an earlier run stored of it. With ``whole`` the files
    are all that the family has, and are found by name instead of listed one by one.
    """
    label = delivery_label(F.col("_metadata.file_path"), raw, shared)
    if whole:
        found = read_family(spark, raw, family, label=label, glob=family_glob(family), staged=True)
    else:
        paths = [row[0] for row in files.select(loadable(F.col("bron"))).collect()]
        found = read_family(spark, paths, family, label=label, staged=True)
    folder = store_path(prepared, family)
    written = write_deliveries(decode_frames(found.tables, family), folder)
    accepted = found.profile.where("reden IS NULL").select(LEVERING, F.map_keys("aantallen").alias("tabellen")).collect()
    read = {row[0] for row in files.select(LEVERING).collect()}
    drop_deliveries(spark, folder, read, {row.levering: set(row.tabellen) for row in accepted})

    unread = files.join(found.profile.select(LEVERING), LEVERING, "left_anti")
    empty = unread.select(LEVERING, F.lit(STAGES[0]).alias("fase"), F.lit("Leeg bestand").alias("reden"))
    rejected = found.rejected.unionAll(empty).select(LEVERING, F.lit(family).alias("bestandstype"), "fase", "reden")
    return written, rejected


def changed_files(spark: SparkSession, files: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files to read, and the manifest as it will be.

    A file that has the path, length and time of the manifest is not opened. One that differs is read once for a number of
    its content: with the same content only the manifest changes.
    """
    fresh = work_table(files.join(manifest, list(SEEN), "left_anti"), "nieuwe-bestanden")
    known = files.join(manifest, list(SEEN)).select(*SEEN, "inhoud")
    numbered = []
    for family in SCHEMAS:
        mine = fresh.where(F.col("bestandstype") == family)
        numbered.append(content_numbers(spark, mine.select(*SEEN, "bron"), "<" if family == "tbgi" else "\n"))
    fresh = work_table(reduce(DataFrame.unionByName, numbered), "gelezen-bestanden")
    same = manifest.select(LEVERING, "bestandstype", "bytes", "inhoud")
    changed = fresh.join(same, [LEVERING, "bestandstype", "bytes", "inhoud"], "left_anti")
    return changed, known.unionByName(fresh.select(*SEEN, "inhoud"))


def normalise_landing(
    spark: SparkSession, raw: str, prepared: str, everything: bool = False
) -> tuple[dict[str, dict[str, int]], DataFrame]:
    """Bring the stores up to date with the deliveries under ``raw``; failing ones end in the quarantine table and do not
    stop the rest. Only new and changed files are read, unless ``everything`` is to be read again; what is gone from
    ``raw`` goes from the stores. Returns the rows written per family and table.

    Without any delivery this raises and leaves the stores as they are.
    """
    files = work_table(discover(spark, raw), "bestanden")
    families = {row.bestandstype for row in files.select("bestandstype").distinct().collect()}
    if not families:
        raise FileNotFoundError(f"Geen leveringen gevonden onder {raw}")
    if shared := shared_labels(files):
        files = work_table(discover(spark, raw, shared), "bestanden")
    earlier = work_table(read_manifest(spark, prepared), "manifest-vooraf")
    changed, manifest = changed_files(spark, files, earlier.limit(0) if everything else earlier)
    changed = work_table(changed, "gewijzigd")
    if not exists(spark, table_path(prepared, MANIFEST)):
        for family in SCHEMAS:  # what is there was never finished
            remove(spark, store_path(prepared, family))
    gone = earlier.join(files, [LEVERING, "bestandstype"], "left_anti").select(LEVERING, "bestandstype").collect()

    schema = "levering string, bestandstype string, fase string, reden string"
    settled = files.join(changed.select(LEVERING, "bestandstype"), [LEVERING, "bestandstype"], "left_anti")
    rejected = spark.createDataFrame([], schema)
    if exists(spark, table_path(prepared, QUARANTINE)):
        before = spark.read.schema(schema).parquet(table_path(prepared, QUARANTINE))
        kept = before.join(settled.select(LEVERING, "bestandstype"), [LEVERING, "bestandstype"], "left_semi")
        rejected = work_table(kept, "quarantaine-vooraf")

    counts = {row.bestandstype: row.n for row in changed.groupBy("bestandstype").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = {row.bestandstype: row.n for row in files.groupBy("bestandstype").agg(F.count(F.lit(1)).alias("n")).collect()}
    written = {}
    for family in SCHEMAS:
        if counts.get(family):
            mine = changed.where(F.col("bestandstype") == family)
            whole = counts[family] == totals[family]
            written[family], bad = normalise_family(spark, raw, prepared, family, mine, shared, whole)
            rejected = rejected.unionAll(bad)
        # Also what no manifest knows of, as after a run that broke off.
        present = {row[0] for row in files.where(F.col("bestandstype") == family).select(LEVERING).collect()}
        stored = stored_deliveries(spark, store_path(prepared, family))
        drop_deliveries(spark, store_path(prepared, family), ({r.levering for r in gone if r.bestandstype == family} | stored) - present, {})
    write_table(work_table(rejected, "quarantaine"), table_path(prepared, QUARANTINE))
    write_manifest(manifest, prepared)
    return written, spark.read.parquet(table_path(prepared, QUARANTINE))


def run_landing_zone(
    spark: SparkSession, raw: str, prepared: str, output: str, options: ObtOptions | None = None, everything: bool = False
) -> LandingResult:
    """Bring the stores up to date with ``raw``, then stack them, build the result tables and write those.

    Only new and changed files are read, see ``normalise_landing``. The result tables are made from the stores as a whole.
    What was staged to type the deliveries is removed before.
    """
    with work_area(spark):
        written, quarantine = normalise_landing(spark, raw, prepared, everything)
    with work_area(spark):
        stacked = stack_store(spark, prepared, harmonised=bool(options and options.harmonised))
        rows = max((df.count() for df in stacked.values()), default=0)
        with settings(spark, **{FIRST_PARTITIONS.replace(".", "__"): first_partitions(spark, rows, ROWS_PER_TASK)}):
            obt = build_obt(stacked, options, set(stacked), store=work_table)
            counts = export_counted(obt, output)
    return LandingResult(written, counts, quarantine, obt_summary(spark, output, counts))


def run_stack(
    spark: SparkSession,
    sources: Sequence[str],
    output: str,
    fmt: str = "parquet",
    label_col: str = LEVERING,
    relative_to: str | None = None,
) -> dict[str, int]:
    """Stack delivery folders and write the stacked tables; return their rows."""
    return export_counted(stack_prepared(spark, sources, label_col, relative_to=relative_to), output, fmt)


def run_obt(
    spark: SparkSession,
    sources: Sequence[str],
    target: str,
    relative_to: str | None = None,
    options: ObtOptions | None = None,
) -> dict[str, DataFrame]:
    """Stack delivery folders, build the five tables, write them and read them back."""
    with work_area(spark):
        stacked = stack_prepared(spark, sources, relative_to=relative_to)
        obt = build_obt(stacked, options, store=work_table)
        export_counted(obt, target)
    return {name: spark.read.parquet(table_path(target, name)) for name in obt}
