"""What queries leave on disk, and how many partitions their shuffles begin with."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundlake.columns import VOLGORDE
from fundlake.plans.obt import ObtBuilder, ObtOptions
from fundlake.session import FIRST_PARTITIONS, configure, first_partitions, work_dir, work_table
from workloads import tables as T
from workloads.queries import landing_obt, landing_twice, obt_full

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")


@given
@pytest.mark.parametrize("query", [landing_obt, landing_twice])
def test_landing_leaves_its_results_alone(spark, query):
    def files():
        return {p for p in Path(work_dir(spark).removeprefix("file:")).rglob("*") if p.is_file() and not p.name.startswith((".", "_"))}

    before = files()
    assert query(spark, FOLDER).count() > 0
    left = files() - before
    assert left and all("/output/" in str(p) for p in left)


@given
def test_shuffles_begin_with_partitions_that_grow_with_the_rows(spark, monkeypatch):
    configure(spark)
    monkeypatch.setattr(T, "ROWS_PER_TASK", 100)
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    obt_full(spark, FOLDER)
    assert int(spark.conf.get(FIRST_PARTITIONS)) == -(-rows // 100) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    configure(spark)
    assert spark.conf.get(FIRST_PARTITIONS, None) is None
    assert first_partitions(spark, 0, 100) == spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(FIRST_PARTITIONS, "77")  # a session's own choice stays
    try:
        obt_full(spark, FOLDER)
        assert configure(spark).conf.get(FIRST_PARTITIONS) == "77"
    finally:
        spark.conf.unset(FIRST_PARTITIONS)


@given
def test_parts_are_stored_and_change_nothing(spark):
    stored = []

    def store_part(df, name):
        stored.append(name)
        return work_table(df, name)

    stacked = T.stacked(T.Source(spark, FOLDER, staged=True), *T.ALL_TABLES)
    plain = ObtBuilder(stacked, present=set(stacked)).obt_inschrijvingen()
    found = ObtBuilder(stacked, present=set(stacked), store_part=store_part).obt_inschrijvingen()
    assert stored == ["deel-GEO", "deel-BPV", "deel-KZD", "deel-AMO"]
    assert found.schema == plain.schema and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


@pytest.mark.parametrize("dedup", [False, True])
def test_exams_without_a_number_are_looked_up(spark, dedup):
    """Blank and missing numbers, an unknown diploma, and one that occurs twice with different enrolments."""
    keys = "levering string, Burgerservicenummer string"
    exams = spark.createDataFrame(
        [("a", "P", number, reference, "3001", mark, n) for n, (number, reference, mark) in enumerate(
            [("E1", "D1", 5), ("", "D1", 7), (None, "D2", 8), ("", "D9", 9), ("E2", "D2", 4), (None, None, 3)])],
        f"{keys}, Inschrijvingvolgnummer string, ResultaatvolgnummerDiploma string, CodeGeneriekExamenonderdeel string, Eindcijfer int, n long",
    )
    exams = exams.withColumn(VOLGORDE, F.struct("n")).drop("n")
    diplomas = spark.createDataFrame([("a", "P", "D1", "E1", 1), ("a", "P", "D2", "E2", 2), ("a", "P", "D2", "E3", 3)], f"{keys}, Resultaatvolgnummer string, Inschrijvingvolgnummer string, n long")
    diplomas = diplomas.withColumn(VOLGORDE, F.struct("n")).drop("n")
    builder = ObtBuilder({"GEO": exams, "DIP": diplomas}, ObtOptions(dedup_dip=dedup), present={"GEO", "DIP"})
    rows = lambda df: sorted(((r.Inschrijvingvolgnummer or "", r.Eindcijfer) for r in df.collect()))
    assert set(rows(builder._exams())) == set(rows(builder.repaired("GEO")))
    assert len(rows(builder._exams())) == (6 if dedup else 7)
