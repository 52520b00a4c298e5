"""Session settings and tables that are written on the way."""

from __future__ import annotations

import atexit
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from fundlake.sources.files import remove

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Stores are partitioned by delivery, and a label such as 1995 stays text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffle files go when the action that wrote them ends; what is used again is written as a table.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Projections over many fields compile to methods the JVM leaves uncompiled above this size; Spark then
    # generates per-operator code in small methods instead, which runs about twice as fast here.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_asked: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job of this package relies on, and drop what ``begin_with`` asked for an earlier one."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(FIRST_PARTITIONS, None) in _asked:
        spark.conf.unset(FIRST_PARTITIONS)
    return spark


def first_partitions(spark: SparkSession, rows: int, rows_per_task: int) -> str:
    """``FIRST_PARTITIONS`` for tables of ``rows``: shuffles begin with so many partitions that no task has to sort more than
    fits its memory, or else it spills; adaptive execution joins small ones. At least the session's shuffle partitions."""
    return str(max(-(-rows // rows_per_task), int(spark.conf.get("spark.sql.shuffle.partitions"))))


def begin_with(spark: SparkSession, partitions: str) -> None:
    """Shuffles begin with so many partitions until the next query is configured: a result is computed when it is asked for."""
    if spark.conf.get(FIRST_PARTITIONS, None) in {None, *_asked}:
        _asked.add(partitions)
        spark.conf.set(FIRST_PARTITIONS, partitions)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings, dots written as two underscores, for the actions inside."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not have it on their path."""
    package = Path(__file__).resolve().parent
    if spark.sparkContext.applicationId in _shipped or not package.is_dir():
        return
    with zipfile.ZipFile(f"{tempfile.mkdtemp()}/{package.name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive.filename)
    _shipped.add(spark.sparkContext.applicationId)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the session names it; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; intermediate tables need a shared folder")
    folder = tempfile.mkdtemp(prefix="fundlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def work_area(spark: SparkSession) -> Iterator[str]:
    """Folder for the work tables of one run, removed at its end. Nothing returned from the run may still read it."""
    folder = f"{work_dir(spark)}/fundlake/run-{uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        remove(spark, folder)


_left: set[tuple[str, str]] = set()


def application_folder(spark: SparkSession) -> str:
    """Folder for what queries stage outside a run: it is removed when the program ends, as results may read it until then."""
    folder = f"{work_dir(spark)}/fundlake/{spark.sparkContext.applicationId}"

    def clear() -> None:
        try:
            remove(spark, folder)
        except Exception:  # the session is gone; nothing can be removed through it
            return

    if (key := (spark.sparkContext.applicationId, folder)) not in _left:
        _left.add(key)
        atexit.register(clear)
    return folder


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: later steps start from files, not from the lineage."""
    spark = df.sparkSession
    path = f"{_run_folder.get() or application_folder(spark)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
