import datetime as dt

import pytest
from pyspark.sql import types as T

from fundlake.columns import VOLGORDE
from fundlake.operators.union import common_type, relaxed_union, tagged_union
from fundlake.sources.exports import export_counted, export_frames, visible
from fundlake.sources.prepared import read_results, stack_prepared, table_names

DAY = dt.date(2024, 8, 1)


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """Two folders with one layout (4 and 3 rows) and one with another (2 rows)."""
    base = tmp_path_factory.mktemp("prepared")
    wide = "Recordsoort string, Burgerservicenummer string, Inschrijvingvolgnummer string, DatumInschrijving date"
    for name, n in (("h15/21AA", 4), ("h15/25BB", 3)):
        rows = [("ISG", str(i), f"A{i}", DAY) for i in range(n)]
        export_frames({"ISG": spark.createDataFrame(rows, wide)}, f"{base}/{name}")
    other = spark.createDataFrame(
        [("ISG", f"P{i}", "27CC", DAY) for i in range(2)],
        "Recordsoort string, PseudoNummer string, BRIN string, DatumInschrijving date",
    )
    export_frames({"ISG": other, "BII": other}, f"{base}/h17/IP")
    return str(base)


def folders(base, *names):
    return [f"{base}/{name}" for name in names]


def labels(df, column="levering"):
    return sorted({r[0] for r in df.select(column).collect()})


def test_common_types():
    assert common_type(T.LongType(), T.DoubleType()) == T.DoubleType()
    assert common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert common_type(T.DoubleType(), T.StringType()) == T.StringType()
    assert common_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert common_type(T.NullType(), T.DateType()) == T.DateType()


def test_relaxed_union_keeps_text_and_column_order(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([("abc", 0.5, "z")], "x string, y double, z string")
    union = relaxed_union([a, b])
    assert union.dtypes == [("x", "string"), ("y", "double"), ("z", "string")]
    assert sorted(map(tuple, union.collect())) == [("1", 2.0, None), ("abc", 0.5, "z")]
    tagged = tagged_union({"A": a, "B": b}).collect()
    assert {(r._bron, r.x) for r in tagged} == {("A", "1"), ("B", "abc")}


def test_stack_nothing_missing_and_mismatch(spark):
    assert stack_prepared(spark, []) == {}
    with pytest.raises(ValueError, match="labels"):
        stack_prepared(spark, ["nope1", "nope2"], labels=["one"])
    with pytest.raises(FileNotFoundError):
        stack_prepared(spark, ["nope"])


def test_stack_counts_labels_and_types(spark, prepared):
    isg = stack_prepared(spark, folders(prepared, "h15/21AA", "h15/25BB"))["ISG"]
    assert isg.count() == 7 and isg.columns[0] == "levering"
    assert labels(isg) == ["21AA", "25BB"]
    assert dict(isg.dtypes)["DatumInschrijving"] == "date"


def test_stack_given_and_relative_labels(spark, prepared):
    pair = folders(prepared, "h15/21AA", "h17/IP")
    given = stack_prepared(spark, pair, label_col="bron", labels=["a", "b"])
    assert labels(given["ISG"], "bron") == ["a", "b"] and given["ISG"].columns[0] == "bron"
    relative = stack_prepared(spark, pair, relative_to=prepared)
    assert labels(relative["ISG"]) == ["h15/21AA", "h17/IP"]
    assert set(relative) == {"ISG", "BII"}


def test_stack_drift_fills_nulls(spark, prepared):
    isg = stack_prepared(spark, folders(prepared, "h15/21AA", "h17/IP"))["ISG"]
    assert visible(isg).columns == [
        "levering",
        "Recordsoort",
        "Burgerservicenummer",
        "Inschrijvingvolgnummer",
        "DatumInschrijving",
        "PseudoNummer",
        "BRIN",
    ]
    assert isg.where("PseudoNummer IS NULL").count() == 4


def test_stack_widens_types_that_do_not_merge(spark, tmp_path):
    for name, rows, schema in (("a", [(1, "x")], "n bigint, t string"), ("b", [(0.5, 7)], "n double, t bigint")):
        export_frames({"T": spark.createDataFrame(rows, schema)}, f"{tmp_path}/{name}")
    stacked = stack_prepared(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])["T"]
    assert sorted(map(tuple, visible(stacked).collect())) == [("a", 1.0, "x"), ("b", 0.5, "7")]


def test_stack_keeps_row_order_of_a_file(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/a/T.parquet")
    stacked = stack_prepared(spark, [f"{tmp_path}/a"])["T"]
    assert [r.id for r in stacked.orderBy(VOLGORDE).collect()] == list(range(100))


def test_export_writes_counts_and_overwrites(spark, tmp_path):
    df = spark.createDataFrame([(1, DAY), (2, None)], "n bigint, d date")
    empty = df.where("n > 9")
    assert export_counted({"A": df, "B": empty}, str(tmp_path)) == {"A": 2, "B": 0}
    paths = export_frames({"A": df}, str(tmp_path))
    assert paths == [f"{tmp_path}/A.parquet"] and table_names(spark, str(tmp_path)) == ["A", "B"]
    assert read_results(spark, str(tmp_path)) == ["A", "B"]
    assert read_results(spark, str(tmp_path), "A").dtypes == df.dtypes


def test_csv_is_readable_elsewhere(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", x', None, DAY)], "t string, n bigint, d date")
    export_frames({"A": df.coalesce(1)}, str(tmp_path), "csv")
    part = next((tmp_path / "A.csv").glob("part-*"))
    assert part.read_text() == 't,n,d\n"say ""hi"", x",,2024-08-01\n'


def test_unknown_format_writes_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="Onbekend formaat"):
        export_frames({"A": spark.range(1)}, f"{tmp_path}/x", "xlsx")
    assert not (tmp_path / "x").exists()
