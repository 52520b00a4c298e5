"""Writing tables as Parquet or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fundlake.columns import HIDDEN, OUDER_PREFIX

FORMATS = ("parquet", "csv")


def visible(df: DataFrame) -> DataFrame:
    """The table without technical columns."""
    return df.drop(*[c for c in df.columns if c in HIDDEN or c.startswith(OUDER_PREFIX)])


def check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Onbekend formaat {fmt!r}; mogelijk: {', '.join(FORMATS)}")


def table_path(folder: str, table: str, fmt: str = "parquet") -> str:
    return f"{str(folder).rstrip('/')}/{table}.{fmt}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table at ``path``; CSV has a header, commas, doubled quotes, ISO dates and empty nulls."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        visible(df).write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)


def export_counted(frames: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, int]:
    """Write every table to ``folder/<table>.<fmt>`` and return its rows, counted while writing."""
    check_format(fmt)
    counts = {}
    for name, df in frames.items():
        seen = Observation(f"rijen {name}")
        write_table(df.observe(seen, F.count(F.lit(1)).alias("rijen")), table_path(folder, name, fmt), fmt)
        counts[name] = seen.get["rijen"]
    return counts


def export_frames(frames: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """Write every table and return the paths."""
    export_counted(frames, folder, fmt)
    return [table_path(folder, name, fmt) for name in frames]
