"""Exam pivot: one shuffle of one row per enrolment, and sorts by the column that tells rows apart."""

import re

import pytest
from pyspark.sql import functions as F

from fundlake.columns import VOLGORDE
from fundlake.operators.aggregates import exam_pivot
from fundlake.operators.joins import first_per_key, left_join_all
from fundlake.operators.keys import ENROLMENT_KEY
from workloads import tables as T

EXAMS = (
    "levering string, _persoon_id string, Inschrijvingvolgnummer string, CodeGeneriekExamenonderdeel string, "
    "Eindcijfer long, CijferIE long, CijferCE long, VrijstellingGeneriekExamenonderdeel string, regel long"
)
ROWS = [
    ("L", "P", "A1", "3001", 7, 65, 70, None, 2),
    ("L", "P", "A1", "3001", 6, 80, None, "VR", 3),
    ("L", "P", "A1", "3.6", None, 1, None, "X", 5),
    ("L", "P", "A1", "3.6", 4, None, None, "Y", 4),
    ("M", "P", "A1", "3001", 5, None, None, "Z", 1),
    ("L", "P", "A2", None, 9, None, 8, "N", 9),
    ("L", None, "A2", "3001", 10, None, None, "V", 1),
    ("L", "P", None, "3001", 10, None, None, "V", 1),
]


@pytest.fixture(scope="module")
def exams(spark):
    df = spark.createDataFrame(ROWS, EXAMS).repartition(3)
    return df.withColumn(VOLGORDE, F.expr("struct(0L AS blok, regel, 0L AS deel)")).drop("regel")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pivot_shuffles_once_and_sorts_by_enrolment(exams):
    turned = exam_pivot(exams)
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", plan(turned))
    assert shuffles == ["Inschrijvingvolgnummer"]
    assert set(re.findall(r"Sort \[(\w+)#", plan(turned))) == {"Inschrijvingvolgnummer"}


def test_pivot_takes_highest_marks_and_first_exemption(exams):
    turned = exam_pivot(exams)
    assert turned.columns[:3] == list(ENROLMENT_KEY) and len(turned.columns) == 3 + 3 * 4
    found = {(r.levering, r._persoon_id, r.Inschrijvingvolgnummer): r.asDict() for r in turned.collect()}
    assert set(found) == {("L", "P", "A1"), ("M", "P", "A1"), ("L", "P", "A2")}
    names = ("Eindcijfer", "CijferIE", "CijferCE", "Vrijstelling")
    row = found["L", "P", "A1"]
    assert [row[f"GEO_3001_{n}"] for n in names] == [7, 80, 70, None]
    assert [row[f"GEO_3.6_{n}"] for n in names] == [4, 1, None, "Y"]
    assert [row[f"GEO_null_{n}"] for n in names] == [None] * 4
    assert [found["L", "P", "A2"][f"GEO_null_{n}"] for n in names] == [9, None, 8, "N"]
    assert [found["M", "P", "A1"][f"GEO_3001_{n}"] for n in names] == [5, None, None, "Z"]
    assert exam_pivot(exams.limit(0)).columns == list(ENROLMENT_KEY)


def test_parts_of_an_enrolment_join_without_another_shuffle(spark, exams):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dates = first_per_key(exams.select(*ENROLMENT_KEY, VOLGORDE, F.lit(1).alias("n")), ENROLMENT_KEY)
        joined = left_join_all(exams, [dates, exam_pivot(exams, ["3001"])], ENROLMENT_KEY)
        assert len(re.findall(r"Exchange hashpartitioning\(Inschrijvingvolgnummer#", plan(joined))) == 3
        assert plan(joined).count("Exchange hashpartitioning(") == 3 and joined.count() == len(ROWS)
        assert set(re.findall(r"Sort \[(\w+)#", plan(joined))) == {"Inschrijvingvolgnummer"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_are_rounded_as_by_round(spark):
    odd = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 4503599627370495.5, 9e15, -9e15, None]
    numbers = odd + [n / 1000 for n in range(-3000, 3000, 5)] + [n / 100 * 100 for n in range(300)]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    assert df.where(f"NOT ({T._rounded('x')} <=> cast(round(x) AS bigint))").count() == 0
    assert df.where(f"NOT ({T._rounded('x * 100')} <=> cast(round(x * 100) AS bigint))").count() == 0
