"""What has to be known about a delivery as a whole before its rows can be typed.

A profile has one row per delivery: separator, encoding, date notation, record counts and the reason to reject it.
It is reduced in steps, so a delivery of any size is first combined inside the tasks that read it and never gathered.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.columns import DATUMFORMAAT, LEVERING, VOLGORDE
from fundlake.functions.typing import bad_number_index, date_format_code, date_format_name, date_sample, quoted
from fundlake.schemas import RecordSpec, load_schema

PLACE = "plek"
# Where a delivery can fail, in the order the stages run.
STAGES = ("lezen", "decoderen", "valideren")


def by_code(family: str, value: Callable[[RecordSpec], str], default: str = "NULL") -> str:
    """SQL per record type: ``value(spec)`` for rows whose ``code`` is that type."""
    cases = " ".join(f"WHEN '{name}' THEN {value(spec)}" for name, spec in load_schema(family).items())
    return f"CASE code {cases} ELSE {default} END"


def summarise_splits(rows: DataFrame, keys: list[str]) -> DataFrame:
    """First-row facts and counts per delivery and key.

    The first step groups within a split by plain numbers, which stays a hash aggregate with map-side combine. The
    second step orders the few rows left by their full position.
    """
    position = [F.col(f"{VOLGORDE}.{name}").alias(name) for name in ("blok", "regel", "deel")]
    within = (
        rows.select(LEVERING, *keys, *position, "klasse", "fout", "breed", "utf8")
        .groupBy(LEVERING, *keys, "blok", "deel")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("regel").alias("regel"),
            F.min_by("klasse", "regel").alias("klasse"),
            F.min_by("breed", "regel").alias("breed"),
            F.min("fout").alias("fout"),
            F.bool_and("utf8").alias("utf8"),
        )
    )
    place = F.struct("blok", "regel", "deel")
    return within.groupBy(LEVERING, *keys).agg(
        F.sum("n").alias("n"),
        F.min(place).alias(PLACE),
        F.min_by("klasse", place).alias("klasse"),
        F.min_by("breed", place).alias("breed"),
        F.min("fout").alias("fout"),
        F.bool_and("utf8").alias("utf8"),
    )


def reject_reason(family: str) -> str:
    """Why the rows of one record type reject their delivery: stage number and message, or null."""

    def reason(spec: RecordSpec) -> str:
        names = ", ".join(f"'{name}'" for name in spec.fields)
        number = (
            f"WHEN fout IS NOT NULL THEN struct(1 AS stap, "
            f"concat('{spec.name}: geen getal in ', get(array({names}), fout)) AS reden)"
        )
        count = (
            f"WHEN n != 1 THEN struct(2 AS stap, "
            f"concat('{spec.name} moet exact 1 rij bevatten, gevonden: ', n) AS reden)"
        )
        return f"CASE {number} {count if spec.single_row else ''} END"

    return by_code(family, reason)


def summarise_deliveries(per_code: DataFrame, family: str, extra: list[Column] | None = None) -> DataFrame:
    """One row per delivery out of one row per delivery and record type (``code`` null for ignored lines)."""
    rank = by_code(family, lambda spec: str(spec.rank))
    known = F.col("code").isNotNull()
    facts = per_code.selectExpr("*", f"{rank} AS rang", f"{reject_reason(family)} AS bezwaar")
    first_format = "min_by(klasse, CASE WHEN code IS NOT NULL AND klasse IS NOT NULL THEN rang END)"
    first_objection = F.min(
        F.when(F.col("bezwaar").isNotNull(), F.struct("bezwaar.stap", "rang", "bezwaar.reden"))
    )
    return facts.groupBy(LEVERING).agg(
        *(extra or []),
        F.expr(date_format_name(first_format)).alias(DATUMFORMAAT),
        F.map_from_entries(
            F.array_sort(F.collect_list(F.when(known, F.struct("code", "n"))))  # one entry per record type
        ).alias("aantallen"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("genegeerd"),
        F.get(F.array(*map(F.lit, STAGES)), first_objection.getField("stap")).alias("fase"),
        first_objection.getField("reden").alias("reden"),
    )


def profile_lines(parsed: DataFrame, family: str) -> DataFrame:
    """Profile of text deliveries from their parsed lines."""
    per_separator = summarise_splits(parsed, ["code", "scheiding"])
    whole = Window.partitionBy(LEVERING)  # at most three separators per record type
    settled = per_separator.withColumn(
        "scheidingsteken", F.when(F.min_by("breed", PLACE).over(whole), F.lit("|")).otherwise(F.lit(";"))
    ).withColumn("latin1", ~F.bool_and("utf8").over(whole))
    used = F.col("scheiding").isin("") | (F.col("scheiding") == F.col("scheidingsteken"))
    per_code = (
        settled.withColumn("code", F.when(used, F.col("code")))
        .groupBy(LEVERING, "scheidingsteken", "latin1", "code")
        .agg(
            F.sum("n").alias("n"),
            F.min_by("klasse", PLACE).alias("klasse"),
            F.min("fout").alias("fout"),
        )
    )
    return summarise_deliveries(
        per_code, family, [F.max("scheidingsteken").alias("scheidingsteken"), F.max("latin1").alias("latin1")]
    )


def profile_frames(frames: dict[str, DataFrame], family: str) -> DataFrame:
    """Profile of deliveries from their raw tables; tables outside the family are left out."""
    specs = load_schema(family)

    def facts(name: str, frame: DataFrame) -> DataFrame:
        spec = specs[name]
        field = {c: quoted(c) for c in frame.columns}
        return frame.selectExpr(
            LEVERING,
            VOLGORDE,
            f"'{name}' AS code",
            f"{date_format_code(date_sample(spec, field))} AS klasse",
            f"{bad_number_index(spec, field)} AS fout",
            "cast(NULL AS boolean) AS breed",
            "true AS utf8",
        )

    tables = [facts(name, frame) for name, frame in frames.items() if name in specs]
    return summarise_deliveries(summarise_splits(reduce(DataFrame.unionAll, tables), ["code"]), family)
