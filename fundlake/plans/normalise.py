"""Raw delivery to typed tables on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from fundlake.columns import LEVERING
from fundlake.operators.decode import decode_frames
from fundlake.operators.validate import validate_multi_record
from fundlake.schemas import PREFIXES
from fundlake.session import work_area
from fundlake.sources.discovery import detect_bestandstype
from fundlake.sources.exports import check_format, export_counted, table_path, visible
from fundlake.sources.multirecord import Deliveries, read_multi_record
from fundlake.sources.tbgi import read_xml


def read_family(
    spark: SparkSession,
    paths: str | list[str],
    family: str,
    label: Column | None = None,
    glob: str | None = None,
    staged: bool = False,
) -> Deliveries:
    """Raw tables of one or many deliveries of a family."""
    if family == "tbgi":
        return read_xml(spark, paths, label, glob)
    return read_multi_record(spark, paths, family, label, glob, staged)


def _accepted(spark: SparkSession, path: str, family: str) -> dict[str, DataFrame]:
    """Raw tables of one delivery, which must be readable and valid."""
    found = read_family(spark, path, family)
    if not found.deliveries:
        raise ValueError(f"Leeg bestand: {path}")
    rejected = found.rejected.first()
    if rejected is not None:
        raise ValueError(f"{rejected.levering}: {rejected.reden}")
    return found.tables


def read_ro(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return _accepted(spark, path, "ro")


def read_grondslag(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return _accepted(spark, path, "grondslag")


def read_tbgi(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return _accepted(spark, path, "tbgi")


def _run(spark: SparkSession, source: str, target: str, fmt: str, family: str) -> dict[str, DataFrame]:
    """Type one delivery and return its tables as they were written; the tables made on the way are removed."""
    check_format(fmt)
    with work_area(spark):
        frames = validate_multi_record(decode_frames(_accepted(spark, str(source), family), family), family)
        own = {name: df.drop(LEVERING) for name, df in frames.items()}
        export_counted(own, target, fmt)
        return {name: _written(spark, df, table_path(target, name, fmt), fmt) for name, df in own.items()}


def _written(spark: SparkSession, df: DataFrame, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(df.schema).parquet(path)
    return spark.read.schema(visible(df).schema).options(header=True, escape='"', emptyValue="").csv(path)


def run_pipeline(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read, type, check and write one RO delivery."""
    return _run(spark, source, target, fmt, "ro")


def run_grondslag_pipeline(
    spark: SparkSession, source: str, target: str, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Read, type, check and write one GRONDSLAG delivery."""
    return _run(spark, source, target, fmt, "grondslag")


def run_tbgi_pipeline(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read, type, check and write one TBGI delivery."""
    return _run(spark, source, target, fmt, "tbgi")


def run_auto_pipeline(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read, type, check and write one delivery whose family shows in its file name."""
    family = detect_bestandstype(source)
    if family is None:
        raise ValueError(f"Onbekend bestandstype: {source!r}. Ondersteund: {sorted(PREFIXES.values())}")
    return _run(spark, source, target, fmt, family)
