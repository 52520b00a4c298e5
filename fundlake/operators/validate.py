"""Checks on a set of tables: required columns and record types that occur exactly once per delivery."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.columns import LEVERING
from fundlake.schemas import load_schema


def missing_columns(frames: dict[str, DataFrame], family: str) -> dict[str, list[str]]:
    """Required columns that a table of the family lacks; extra columns are fine."""
    gaps = {
        name: sorted(set(spec.fields) - set(frames[name].columns))
        for name, spec in load_schema(family).items()
        if name in frames
    }
    return {name: columns for name, columns in gaps.items() if columns}


def single_row_violations(frames: dict[str, DataFrame], family: str) -> DataFrame | None:
    """Deliveries in which a single-row record type occurs more than once: levering, recordtype, aantal.

    A record type without rows in a delivery passes. None when the set holds no such record type.
    """
    counts = [
        frames[name].groupBy(LEVERING).agg(F.lit(name).alias("recordtype"), F.count(F.lit(1)).alias("aantal"))
        for name, spec in load_schema(family).items()
        if spec.single_row and name in frames
    ]
    return reduce(DataFrame.unionAll, counts).where(F.col("aantal") != 1) if counts else None


def validate_multi_record(frames: dict[str, DataFrame], family: str) -> dict[str, DataFrame]:
    """Return ``frames`` when every check passes, else raise ``ValueError`` with the first violation."""
    for name, columns in missing_columns(frames, family).items():
        raise ValueError(f"{name}: ontbrekende kolommen {columns}")
    violations = single_row_violations(frames, family)
    first = None if violations is None else violations.orderBy(LEVERING, "recordtype").first()
    if first is not None:
        raise ValueError(
            f"{first.recordtype} moet exact 1 rij bevatten, gevonden: {first.aantal} ({first.levering})"
        )
    return frames


def validate_ro(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return validate_multi_record(frames, "ro")


def validate_grondslag(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return validate_multi_record(frames, "grondslag")


def validate_tbgi(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return validate_multi_record(frames, "tbgi")
