"""Multi-record text deliveries: many record types in one header-less file, all deliveries of a family at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.columns import DATUMFORMAAT, LEVERING, VOLGORDE
from fundlake.functions.text import (
    as_latin1,
    decoded,
    field_at,
    has_text,
    line_parts,
    prefers_pipe,
    record_code,
    separator_after,
    split_fields,
)
from fundlake.functions.typing import bad_number_index, date_format_code, date_sample, quoted
from fundlake.operators.joins import lookup_join
from fundlake.schemas import RecordSpec, load_schema
from fundlake.session import work_table
from fundlake.sources.discovery import file_label
from fundlake.sources.files import require_path
from fundlake.sources.profile import by_code, profile_lines

_ROW_IN_PARTITION = (1 << 33) - 1
# Profile rows hold a label and three short fields; this many are about 250 MB.
PROFILE_BROADCAST_ROWS = 2_000_000


@dataclass
class Deliveries:
    """Raw tables of a family plus the profile of every delivery in them."""

    family: str
    tables: dict[str, DataFrame]
    profile: DataFrame
    deliveries: int

    @property
    def rejected(self) -> DataFrame:
        return self.profile.where(F.col("reden").isNotNull()).select(LEVERING, "fase", "reden")


def read_lines(
    spark: SparkSession, paths: str | list[str], label: Column | None = None, glob: str | None = None
) -> DataFrame:
    """Non-blank lines of text files: levering, position, text, utf8.

    The text source cuts large files into splits, so one huge delivery is read by many tasks. Position is the
    offset of the split plus the row within it, both fixed by the file itself. A byte-order mark is dropped.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    uri = F.col("_metadata.file_path")
    raw = reader.text(paths).select(
        (file_label(uri) if label is None else label).alias(LEVERING),
        F.col("_metadata.file_block_start").alias("blok"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)).alias("regel"),
        "value",
    )
    return decode_lines(raw)


def decode_lines(raw: DataFrame) -> DataFrame:
    """Text of undecoded lines (levering, blok, regel, value), cut at rare line ends, blank ones dropped."""
    utf8 = F.is_valid_utf8("value")
    pieces = line_parts(decoded(F.col("value"), utf8))
    parts = raw.select(LEVERING, "blok", "regel", utf8.alias("utf8"), F.posexplode(pieces))
    return parts.where(has_text(F.col("col"))).select(
        LEVERING,
        F.struct("blok", "regel", F.col("pos").cast("bigint").alias("deel")).alias(VOLGORDE),
        F.col("col").alias("tekst"),
        "utf8",
    )


def parse_lines(lines: DataFrame, family: str) -> DataFrame:
    """Route every line to its record type and split it.

    A known line is split by the separator that follows its record type, so parsing needs no knowledge of the
    delivery; whether that separator is the delivery's own is settled by the profile. Lines of unknown type keep a
    null ``code``.
    """
    specs = load_schema(family)
    routed = lines.withColumn("code", F.nullif(record_code(F.col("tekst"), specs), F.lit("")))
    text, code = F.col("tekst"), F.col("code")
    split = (
        routed.withColumn("breed", prefers_pipe(text))
        .withColumn("scheiding", F.when(code.isNotNull(), separator_after(text, code)))
        .withColumn("velden", F.when(code.isNotNull(), split_fields(text, F.col("scheiding"))))
    )

    def fields(spec: RecordSpec) -> dict[str, str]:
        return {name: field_at("velden", i) for i, name in enumerate(spec.fields)}

    sampled = split.selectExpr(
        "*",
        f"{by_code(family, lambda spec: date_sample(spec, fields(spec)))} AS monster",
        f"{by_code(family, lambda spec: bad_number_index(spec, fields(spec)))} AS fout",
    )
    return sampled.selectExpr(
        LEVERING,
        VOLGORDE,
        "code",
        "scheiding",
        "velden",
        "utf8",
        "breed",
        f"{date_format_code('monster')} AS klasse",
        "fout",
    )


def raw_table(parsed: DataFrame, profile: DataFrame, deliveries: int, family: str, code: str) -> DataFrame:
    """All-text table of one record type over the accepted deliveries."""
    accepted = profile.where(F.col("reden").isNull()).select(LEVERING, "scheidingsteken", "latin1", DATUMFORMAAT)
    rows = lookup_join(
        parsed.where(F.col("code") == code).select(LEVERING, VOLGORDE, "scheiding", "velden", "utf8"),
        accepted,
        [LEVERING],
        "inner",
        right_rows=deliveries,
        broadcast_rows=PROFILE_BROADCAST_ROWS,
    ).where((F.col("scheiding") == F.col("scheidingsteken")) | (F.col("scheiding") == ""))
    text = F.when(F.col("latin1") & F.col("utf8"), F.transform("velden", as_latin1)).otherwise(F.col("velden"))
    fields = load_schema(family)[code].fields
    return rows.withColumn("velden", text).selectExpr(
        LEVERING, *[f"{field_at('velden', i)} AS {quoted(f)}" for i, f in enumerate(fields)], VOLGORDE, DATUMFORMAAT
    )


def tables_of(parsed: DataFrame, family: str, profile: DataFrame | None = None) -> Deliveries:
    """Raw tables of parsed lines. Record types without a row in any accepted delivery are absent."""
    profile = work_table(profile_lines(parsed, family) if profile is None else profile, f"profiel-{family}")
    summary = profile.agg(
        F.count(F.lit(1)).alias("n"),
        F.array_distinct(
            F.flatten(F.collect_set(F.when(F.col("reden").isNull(), F.map_keys("aantallen"))))
        ).alias("codes"),
    ).first()
    present = [code for code in load_schema(family) if code in summary.codes]
    tables = {code: raw_table(parsed, profile, summary.n, family, code) for code in present}
    return Deliveries(family, tables, profile, summary.n)


def stage_lines(parsed: DataFrame, family: str) -> DataFrame:
    """Parsed lines written once, sorted by record type within each file: every table skips the pages of the others, and
    there are as many files as reading tasks, not as many as tasks times record types."""
    return work_table(parsed.sortWithinPartitions("code"), f"regels-{family}")


def read_multi_record(
    spark: SparkSession,
    paths: str | list[str],
    family: str,
    label: Column | None = None,
    glob: str | None = None,
    staged: bool = False,
) -> Deliveries:
    """Read all text deliveries under ``paths``: two passes over the files, or one when ``staged``."""
    load_schema(family)
    if isinstance(paths, str):  # a list is of files that were found
        require_path(spark, paths)
    parsed = parse_lines(read_lines(spark, paths, label, glob), family)
    return tables_of(stage_lines(parsed, family) if staged else parsed, family)
