"""Reading written tables back: one folder per delivery, or one store for all deliveries of a family."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.columns import LEVERING, VOLGORDE
from fundlake.operators.codes import harmonise
from fundlake.operators.joins import lookup_join
from fundlake.operators.union import relaxed_union
from fundlake.schemas import SCHEMAS
from fundlake.sources.discovery import base_name, plain_path, plain_root
from fundlake.sources.exports import table_path
from fundlake.sources.files import children, exists, require_path

SUFFIX = ".parquet"


def table_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the Parquet tables in a folder, sorted."""
    return [name.removesuffix(SUFFIX) for name in children(spark, folder) if name.endswith(SUFFIX)]


def _source_folder(table: str) -> Column:
    """Folder of the delivery a row was read from; a table is a file or a folder of part files."""
    path = plain_path(F.col("_metadata.file_path"))
    return F.regexp_replace(path, rf"/\Q{table}{SUFFIX}\E(/[^/]*)?$", "")


def _read(spark: SparkSession, paths: Sequence[str], table: str, merge: bool) -> DataFrame:
    """Tables of several deliveries in one scan, with the folder and a position for every row."""
    raw = spark.read.option("mergeSchema", str(merge).lower()).parquet(*paths)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-([0-9]+)", 1)
    stored = F.struct(
        F.coalesce(part.try_cast("bigint"), F.lit(0)).alias("blok"),
        F.col("_metadata.row_index").alias("regel"),
        F.lit(0).cast("bigint").alias("deel"),
    )
    position = F.coalesce(VOLGORDE, stored) if VOLGORDE in raw.columns else stored
    return raw.select(
        *[c for c in raw.columns if c != VOLGORDE], position.alias(VOLGORDE), _source_folder(table).alias("_map")
    )


def _scan(spark: SparkSession, paths: list[str], table: str) -> DataFrame:
    """One scan where the schemas merge; otherwise one per distinct schema, widened and united."""
    try:
        return _read(spark, paths, table, merge=len(paths) > 1)
    except (PySparkException, Py4JJavaError) as error:  # the JVM's exception type has no Python class of its own
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(spark.read.parquet(path).schema.json(), []).append(path)
    return relaxed_union([_read(spark, group, table, merge=False) for group in groups.values()])


def stack_prepared(
    spark: SparkSession,
    sources: Sequence[str],
    label_col: str = LEVERING,
    labels: Sequence[str] | None = None,
    relative_to: str | None = None,
) -> dict[str, DataFrame]:
    """Stack the tables of delivery folders under a label column, which comes first.

    Labels are given, or the path below ``relative_to``, or the folder name. Missing columns become null and
    differing types meet in the wider one. Tables found in one source only are kept.
    """
    folders = [str(s).rstrip("/") for s in sources]
    if not folders:
        return {}
    if labels is not None and len(labels) != len(folders):
        raise ValueError(f"{len(folders)} bronmappen vragen evenveel labels, niet {len(labels)}")
    for folder in folders:
        require_path(spark, folder, "Bronmap")

    tables: dict[str, list[str]] = {}
    for folder in folders:
        for name in table_names(spark, folder):
            tables.setdefault(name, []).append(table_path(folder, name))

    if labels is not None:
        given = [(plain_root(folder), label) for folder, label in zip(folders, labels, strict=True)]
        mapping = spark.createDataFrame(given, ["_map", "_label"])

    def labelled(name: str, paths: list[str]) -> DataFrame:
        rows = _scan(spark, paths, name)
        if labels is not None:
            rows = lookup_join(rows, mapping, ["_map"], right_rows=len(folders))
            label = F.col("_label")
        elif relative_to is not None:
            label = F.substr(F.col("_map"), F.lit(len(plain_root(relative_to)) + 2))
        else:
            label = base_name(F.col("_map"))
        rest = [c for c in rows.columns if c not in (label_col, "_map", "_label")]
        return rows.select(label.alias(label_col), *rest)

    return {name: labelled(name, paths) for name, paths in tables.items()}


def read_store(spark: SparkSession, prepared: str, family: str) -> dict[str, DataFrame]:
    """The tables of a family's store, the delivery first."""
    folder = f"{str(prepared).rstrip('/')}/{family}"
    names = table_names(spark, folder) if exists(spark, folder) else []
    stored = {name: spark.read.parquet(table_path(folder, name)) for name in names}
    return {name: df.select(LEVERING, *[c for c in df.columns if c != LEVERING]) for name, df in stored.items()}


def stack_store(spark: SparkSession, prepared: str, harmonised: bool = False) -> dict[str, DataFrame]:
    """Stack the family stores of a landing zone: at most one union leg per family, whatever the deliveries.
    ``harmonised`` writes the codes of all families in one coding first."""
    legs: dict[str, list[DataFrame]] = {}
    for family in SCHEMAS:
        tables = read_store(spark, prepared, family)
        for name, df in (harmonise(tables, family) if harmonised else tables).items():
            legs.setdefault(name, []).append(df)
    return {name: frames[0] if len(frames) == 1 else relaxed_union(frames) for name, frames in legs.items()}


def read_results(spark: SparkSession, output: str, table: str | None = None) -> list[str] | DataFrame:
    """Names of the result tables, or one of them."""
    require_path(spark, output, "Resultatenmap")
    return table_names(spark, output) if table is None else spark.read.parquet(table_path(output, table))
