"""Per-enrolment aggregates. Every one combines before the shuffle and leaves one row per enrolment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.columns import VOLGORDE
from fundlake.operators.joins import all_filled, finest_first
from fundlake.operators.keys import ENROLMENT_KEY

# Exam measures, the short names of their pivot columns and the word for a passed elective.
EXAM_CODE = "CodeGeneriekExamenonderdeel"
EXAM_MARKS = ("Eindcijfer", "CijferIE", "CijferCE")
EXAM_EXEMPTION = ("VrijstellingGeneriekExamenonderdeel", "Vrijstelling")
PASSED = "BEHAALD"
# End of fixed values.


def _per_enrolment(df: DataFrame, *measures: Column) -> DataFrame:
    """Measures per enrolment. Rows without a full key are left out: no enrolment row can match them."""
    keyed = df.where(all_filled(ENROLMENT_KEY))
    if not measures:
        return keyed.select(*ENROLMENT_KEY).distinct()
    measured = keyed.groupBy(*finest_first(ENROLMENT_KEY)).agg(*measures)
    # Names are quoted, as a pivot column has an exam code in its name.
    names = [f"`{name.replace('`', '``')}`" for name in measured.columns[len(ENROLMENT_KEY) :]]
    return measured.select(*ENROLMENT_KEY, *names)


def placement_totals(placements: DataFrame) -> DataFrame:
    """Number of placements, total hours (0.0 when all are blank), first start and last actual end."""
    hours = F.col("Omvang").try_cast("double")
    return _per_enrolment(
        placements,
        F.count(F.lit(1)).alias("BPV_Aantal"),
        F.coalesce(F.sum(hours), F.lit(0.0)).alias("BPV_TotaalOmvang"),
        F.min("DatumBegin").alias("BPV_DatumBeginEerste"),
        F.max("DatumEindWerkelijk").alias("BPV_DatumEindLaatste"),
    )


def elective_totals(electives: DataFrame, passed: str = "contains") -> DataFrame:
    """Number of electives and of passed ones.

    ``passed="contains"`` counts every result holding the word, which includes a negated one;
    ``passed="exact"`` asks for the word alone.
    """
    result = F.upper("Resultaat")
    if passed == "contains":
        hit = F.contains(result, F.lit(PASSED))
    elif passed == "exact":
        hit = F.trim(result) == PASSED
    else:
        raise ValueError(f"passed: 'contains' of 'exact', niet {passed!r}")
    return _per_enrolment(
        electives,
        F.count(F.lit(1)).alias("KZD_Aantal"),
        F.coalesce(F.sum(hit.cast("bigint")), F.lit(0)).alias("KZD_AantalBehaald"),
    )


def module_totals(modules: DataFrame) -> DataFrame:
    """Number of legally required modules."""
    return _per_enrolment(modules, F.count(F.lit(1)).alias("AMO_Aantal"))


def exam_codes(exams: DataFrame) -> list[str]:
    """Distinct exam codes, sorted. A short code list; past Spark's limit on pivot values this fails."""
    limit = int(exams.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    codes = exams.select(F.coalesce(EXAM_CODE, F.lit("null")).alias("code")).distinct().limit(limit + 1).collect()
    if len(codes) > limit:
        raise ValueError(f"meer dan {limit} examencodes")
    return sorted(row.code for row in codes)


def exam_pivot(exams: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Columns ``GEO_{code}_{measure}``: highest marks and first exemption per enrolment and exam code.

    Rows are turned and reduced to one per enrolment where they are read, and only those are shuffled.
    """
    codes = exam_codes(exams) if codes is None else codes
    source, short = EXAM_EXEMPTION
    code = F.coalesce(EXAM_CODE, F.lit("null"))
    measures = []
    for value in codes:
        of_code = code == F.lit(value)
        measures += [F.max(F.when(of_code, F.col(mark))).alias(f"GEO_{value}_{mark}") for mark in EXAM_MARKS]
        earliest = F.min(F.when(of_code, F.struct(VOLGORDE, source))).getField(source)
        measures.append(earliest.alias(f"GEO_{value}_{short}"))
    return _per_enrolment(exams, *measures)
