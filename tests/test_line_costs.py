"""Cheaper ways to the same lines: dates without a formatter, separators without counting."""

import pytest
from pyspark.sql import functions as F

from fundlake.functions.text import prefers_pipe, split_fields
from workloads.rendered import day

LINES = ["", "|", ";", "PER", "PER|a|b", "PER;a;b;;;", "PER|a;b|c||", "PER;a|b", "a;b|", "|;|;", ";;;", "é|ü;x||", None]


@pytest.mark.parametrize(("notation", "pattern"), [("iso", "yyyy-MM-dd"), ("dutch", "d-M-yyyy")])
def test_days_are_those_of_a_formatter(spark, notation, pattern):
    dates = spark.range(-719162, 2932896, 97).selectExpr("date_from_unix_date(cast(id AS int)) AS dag")
    dates = dates.unionAll(spark.sql("SELECT cast(NULL AS date)"))
    assert "date_format" not in day("dag", notation)
    assert dates.where(f"{day('dag', notation)} != coalesce(date_format(dag, '{pattern}'), '')").count() == 0
    assert dates.where(f"{day('dag', notation)} IS NULL").count() == 0


def test_preferred_separator_is_that_of_the_counts(spark):
    df = spark.createDataFrame([(line,) for line in LINES], "tekst string")
    column = prefers_pipe(F.col("tekst"))
    assert "contains" in str(column).lower()
    found = df.select("tekst", column.alias("breed")).collect()
    assert [r.breed for r in found] == [None if r.tekst is None else r.tekst.count("|") >= r.tekst.count(";") for r in found]


def test_trailing_separators_are_dropped(spark):
    df = spark.createDataFrame([(line, s) for line in LINES for s in ("|", ";", "", None)], "tekst string, scheiding string")
    column = split_fields(F.col("tekst"), F.col("scheiding"))
    assert "endswith" in str(column).lower()
    for r in df.select("*", column.alias("velden")).collect():
        if r.tekst is None or r.scheiding is None:
            wanted = None
        else:
            wanted = r.tekst.rstrip(r.scheiding).split("|" if r.scheiding == "|" else ";") if r.scheiding else r.tekst.split(";")
        assert r.velden == wanted
