"""What the name of a delivery tells, and which deliveries a newer one replaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.columns import LEVERING
from fundlake.operators.intervals import first_day
from fundlake.session import work_table
from fundlake.sources.discovery import family_of, stem

# File names, upper case: the family's prefix, the school, and two numbers (per family: first and last day of
# the selection; funding year and day of making; day of making and study year).
NAME = r"^(?:RO|TBGI|GRONDSLAG_IP_MBO)_([0-9A-Z]{4}_[0-9]{4,8}_[0-9]{4,8})(?![0-9])"
# End of fixed values.


def decode_name(name: Column) -> Column:
    """Struct of a file name: bestandstype, brin, begin and eind of the period, aanmaak (null for RO, which has none),
    bekostigingsjaar and studiejaar where the name has them. Null for other names; days that do not exist are null."""
    family = family_of(name)

    def told(parts: Column) -> Column:
        first, second = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
        day = lambda c: F.when(F.length(c) == 8, F.try_to_date(c, "yyyyMMdd"))
        year = F.when(family == "tbgi", first).when(family == "grondslag", second)
        number = F.when(F.length(year) == 4, year.try_cast("int"))
        start = F.when(family == "tbgi", number - 2).otherwise(number)
        return F.struct(
            family.alias("bestandstype"),
            F.get(parts, F.lit(0)).alias("brin"),
            F.when(family == "ro", day(first)).otherwise(first_day(start)).alias("begin"),
            F.when(family == "ro", day(second)).otherwise(F.date_sub(first_day(start + 1), 1)).alias("eind"),
            F.when(family == "tbgi", day(second)).when(family == "grondslag", day(first)).alias("aanmaak"),
            F.when(family == "tbgi", number).alias("bekostigingsjaar"),
            F.when(family == "grondslag", number).alias("studiejaar"),
        )

    text = F.regexp_extract(F.upper(stem(name)), NAME, 1)
    return F.get(F.transform(F.array(F.when(text != "", F.split(text, "_"))), lambda parts: F.when(parts.isNotNull(), told(parts))), F.lit(0))


def superseded(deliveries: DataFrame) -> DataFrame:
    """``deliveries`` (levering, bestandstype, brin, begin, eind, aanmaak) with ``vervangen_door``: the newest delivery of the
    same school and family that is newer and whose period overlaps, null if there is none.

    Newer is a later aanmaak, else a later eind, else a later begin, else a label that comes later. Deliveries without
    a school or a period replace nothing and are not replaced.
    """
    age = F.struct(F.coalesce("aanmaak", F.lit("0001-01-01").cast("date")), "eind", "begin", LEVERING)
    school, period = ["bestandstype", "brin"], ["begin", "eind"]
    deliveries = work_table(deliveries, "leveringen")  # names are decoded once
    usable = deliveries.where("brin IS NOT NULL AND begin IS NOT NULL AND eind IS NOT NULL")
    named = usable.select(*school, *period, LEVERING, age.alias("leeftijd"))
    newest = newest_overlapping(work_table(named.groupBy(*school, *period).agg(F.max("leeftijd").alias("leeftijd")), "perioden"), school)
    newer = named.join(newest, [*school, *period]).where(F.col("nieuwste") > F.col("leeftijd")).groupBy("bestandstype", LEVERING).agg(
        F.max("nieuwste").getField(LEVERING).alias("vervangen_door")
    )
    return deliveries.join(newer, ["bestandstype", LEVERING], "left").select(*deliveries.columns, "vervangen_door")


def newest_overlapping(periods: DataFrame, school: list[str]) -> DataFrame:
    """For each period (school, begin, eind) ``nieuwste``: the highest leeftijd of a period of the school that overlaps.

    No pair of periods is made. Days are dealt to blocks of 1, 2, 4 ... days; a period is in the blocks of its first day, and
    the days up to a last day are at most one block of each size. In a block, ordered by last day from the latest on, a
    running maximum is the highest leeftijd of those that end on a day or later.
    """
    first, last = periods.agg(F.min("begin"), F.max("begin")).first()
    if first is None:
        return periods.withColumnRenamed("leeftijd", "nieuwste")
    since = lambda c: F.date_diff(c, F.lit(first))
    days = (last - first).days + 1
    block, sizes = [*school, "maat", "blok"], periods.select("*", F.explode(F.sequence(F.lit(0), F.lit(days.bit_length() - 1))).alias("maat"))
    blocked = lambda day, size: F.expr(f"shiftright({day}, {size})")
    begun = sizes.withColumn("dag", since("begin")).select(
        *school, "maat", blocked("dag", "maat").alias("blok"), F.col("eind").alias("tot"), F.lit(0).alias("vraag"), "leeftijd",
        F.lit(None).cast("date").alias("begin"), F.lit(None).cast("date").alias("eind"),
    )
    asked = sizes.withColumn("dag", F.least(since("eind") + 1, F.lit(days))).where("dag > 0 AND shiftright(dag, maat) % 2 = 1").select(
        *school, "maat", (blocked("dag", "maat") - 1).alias("blok"), F.col("begin").alias("tot"), F.lit(1).alias("vraag"),
        F.lit(None).cast(periods.schema["leeftijd"].dataType).alias("leeftijd"), "begin", "eind",
    )
    order = Window.partitionBy(*block).orderBy(F.desc("tot"), "vraag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = begun.unionByName(asked).withColumn("nieuwste", F.max("leeftijd").over(order)).where("vraag = 1 AND nieuwste IS NOT NULL")
    return found.groupBy(*school, "begin", "eind").agg(F.max("nieuwste").alias("nieuwste"))


def named_deliveries(files: DataFrame) -> DataFrame:
    """Discovered files (levering, pad) with what their names tell; files with other names are left out."""
    name = F.element_at(F.split("pad", "/"), -1)
    return files.select(LEVERING, "pad", F.inline(F.array(decode_name(name)))).where("brin IS NOT NULL")
