"""What the operators share: session settings, reading a table, and tables staged in the shared folder."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import configure, work_table

SETTINGS = {
    # Batches that Python gets are bounded by rows and by bytes: texts can be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not have it on their path."""
    package = Path(__file__).resolve().parent.parent
    if spark.sparkContext.applicationId in _shipped or not package.is_dir():
        return
    with zipfile.ZipFile(f"{tempfile.mkdtemp()}/{package.name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive.filename)
    _shipped.add(spark.sparkContext.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """The library's settings and those of this subpackage."""
    _ship(spark)
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, folder: str, table: str, **columns: str) -> DataFrame:
    """``table`` in ``folder``, cut to ``columns`` (name to type); other columns are never read."""
    source = prepare(spark).read.parquet(f"{str(folder).rstrip('/')}/{table}.parquet")
    return pick(source, **columns)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in columns.items()))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written once to the folder in ``spark.checkpoint.dir`` and read back, so that a lost executor costs a re-read."""
    return work_table(df, name)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def first_by_hash(df: DataFrame, rows: int, total: int, *columns: str) -> DataFrame:
    """The first ``rows`` of ``total`` rows in the order of a hash of ``columns``; the same ones at any partitioning.

    All but about twice as many are left out where they are read, so that tasks do not each send ``rows`` of them.
    """
    order, steps = F.xxhash64(*columns), 1 << 30
    share = min(steps, -(-(2 * rows + 100) * steps // max(1, total)))
    return df.where(F.pmod(order, F.lit(steps)) < share).orderBy(order, *columns).limit(rows)


def buckets_for(rows: int, per_bucket: int) -> int:
    """Number of buckets that hold ``per_bucket`` rows on average."""
    return max(1, -(-rows // per_bucket))
