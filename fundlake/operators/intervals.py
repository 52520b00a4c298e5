"""Values that hold for a time: lookups by date, and periods cut at the ends of study years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.operators.joins import BROADCAST_CHARS, BROADCAST_ROWS, all_filled, counted_side

# Fixed value: a study year begins on this day.
FIRST_MONTH = 8
# End of fixed values.


def disjoint(table: DataFrame, on: Sequence[str], begin: str, end: str) -> DataFrame:
    """``table`` with validities that do not overlap within a key: each ends the day before the next one begins. Of rows
    that begin on one day the one that ends last holds; a null end is open. Rows without a key or a begin go."""
    day = F.coalesce(end, F.lit("9999-12-31").cast("date"))
    rank = F.row_number().over(Window.partitionBy(*on, begin).orderBy(day.desc(), *[F.col(c) for c in table.columns if c not in (*on, begin, end)]))
    single = table.where(all_filled([*on, begin])).withColumn("_rij", rank).where("_rij = 1").drop("_rij")
    following = F.lead(begin).over(Window.partitionBy(*on).orderBy(begin))
    return single.withColumn(end, F.least(F.col(end), F.date_sub(following, 1)))


def valid_at(left: DataFrame, table: DataFrame, on: Sequence[str], at: str, begin: str, end: str) -> DataFrame:
    """Left join with the row of ``table`` that holds on the day ``at``: one row per row of ``left``, nulls where none holds.

    The join is on the key, with the days as a condition; a key has one row per period in ``table``. It is broadcast only
    if counted small enough.
    """
    validities = disjoint(table, on, begin, end)
    rows, chars = counted_side(validities)
    names = {c: f"_r_{c}" for c in (*on, begin, end)}
    right = validities.withColumnsRenamed(names)
    if rows <= BROADCAST_ROWS and chars <= BROADCAST_CHARS:
        right = F.broadcast(right)
    match = [F.col(c) == F.col(names[c]) for c in on]
    match += [F.col(at) >= F.col(names[begin]), F.col(names[end]).isNull() | (F.col(at) <= F.col(names[end]))]
    return left.join(right, match, "left").drop(*names.values())


def study_year(day: Column) -> Column:
    """Calendar year in which the study year of a day begins."""
    return F.year(day) - (F.month(day) < FIRST_MONTH).cast("int")


def first_day(year: Column) -> Column:
    return F.make_date(year, F.lit(FIRST_MONTH), F.lit(1))


def funding_year_of_enrolment(year: Column) -> Column:
    """Funding year in which enrolments of a study year count: two years after the year it begins in."""
    return year + 2


def funding_year_of_diploma(day: Column) -> Column:
    """Funding year in which a diploma counts: two years after the calendar year of the result."""
    return F.year(day) + 2


def split_by_study_year(periods: DataFrame, begin: str, end: str, until: Column) -> DataFrame:
    """A row for each study year that a period covers: studiejaar, bekostigingsjaar, van, tot (both included) and dagen.

    An open end, and one after ``until``, is ``until``. Periods without a begin, or that end before they begin, give none.
    """
    last = F.least(F.coalesce(F.col(end), until), until)
    clipped = periods.withColumn("_tot", last).where(F.col(begin) <= F.col("_tot"))
    years = F.sequence(study_year(F.col(begin)), study_year(F.col("_tot")))
    split = clipped.withColumn("studiejaar", F.explode(years))
    van = F.greatest(F.col(begin), first_day(F.col("studiejaar")))
    tot = F.least(F.col("_tot"), F.date_sub(first_day(F.col("studiejaar") + 1), 1))
    return split.select(
        *periods.columns, "studiejaar", funding_year_of_enrolment(F.col("studiejaar")).alias("bekostigingsjaar"),
        van.alias("van"), tot.alias("tot"), (F.datediff(tot, van) + 1).alias("dagen"),
    )
