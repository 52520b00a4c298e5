"""First-row joins against brute force, with one key holding a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from fundlake.columns import VOLGORDE
from fundlake.operators import joins
from fundlake.operators.joins import (
    first_per_key,
    hot_keys,
    keep_first_left_join,
    left_join_all,
    lookup_join,
    split_hot_keys,
)

ON = ["levering", "k"]
POSITION = f"struct(0L AS blok, cast(id AS bigint) AS regel, 0L AS deel) AS {VOLGORDE}"
SPLIT = {"hot_rows": 20}


def skewed(seed=1, rows=600):
    """A third of the rows on one key, a third on null, the rest spread; two rows of the key are exact copies."""
    rng = random.Random(seed)
    keys = ["hot"] * (rows // 3) + [None] * (rows // 3) + [f"k{rng.randrange(50)}" for _ in range(rows // 3)]
    rng.shuffle(keys)
    return [("L", key, i, i // 2) for i, key in enumerate(keys)]


@pytest.fixture(scope="module")
def left(spark):
    return spark.createDataFrame(skewed(), "levering string, k string, id long, v long").selectExpr(
        "levering", "k", "v", POSITION
    )


@pytest.fixture(scope="module")
def right_rows():
    rng = random.Random(2)
    keys = ["hot"] * 40 + [None] * 40 + [f"k{rng.randrange(60)}" for _ in range(80)]
    rng.shuffle(keys)
    return [("L", key, i, f"w{i}") for i, key in enumerate(keys)]


@pytest.fixture(scope="module")
def right(spark, right_rows):
    return spark.createDataFrame(right_rows, "levering string, k string, id long, v string").selectExpr(
        "levering", "k", "v", POSITION
    )


def brute_force(right_rows):
    first = {}
    for _, key, _, value in right_rows:
        if key is not None:
            first.setdefault(key, value)
    return sorted(((k or "", v, first.get(k) or "") for _, k, _, v in skewed()))


def result(df):
    return sorted((r.k or "", r.v, r.v_r or "") for r in df.collect())


@pytest.mark.parametrize("limits", [{}, SPLIT])
def test_keep_first_join(left, right, right_rows, limits):
    joined = keep_first_left_join(left, right, ON, **limits)
    assert joined.columns == ["levering", "k", "v", VOLGORDE, "v_r"]
    assert result(joined) == brute_force(right_rows)


def test_input_order_of_partitions_does_not_matter(left, right, right_rows):
    shuffled = keep_first_left_join(left.orderBy(F.rand(3)), right.repartition(7).orderBy(F.rand(4)), ON)
    assert result(shuffled) == brute_force(right_rows)


def test_first_row_is_chosen_before_the_shuffle(right):
    plan = first_per_key(right, ON)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_hot_keys_and_nulls_are_spread(left, right):
    hot = hot_keys(left, ON, 20)
    assert {r._delen for r in hot.collect()} == {10}
    sliced, (copies,) = split_hot_keys(left, [first_per_key(right, ON)], ON, hot)
    per_slice = {(r.k, r._deel): r["count"] for r in sliced.groupBy("k", "_deel").count().collect()}
    assert max(n for (k, _), n in per_slice.items() if k in ("hot", None)) < 60
    assert len([1 for k, _ in per_slice if k == "hot"]) == 10
    assert copies.where("k = 'hot'").count() == 10 and copies.where("k = 'k1'").count() <= 1


def test_several_rights_on_one_shuffle(left, right, right_rows):
    other = right.groupBy(*ON).agg(F.count("*").alias("n")).where("k IS NOT NULL")
    plain, split = (left_join_all(left, [first_per_key(right, ON), other], ON, **limits) for limits in ({}, SPLIT))
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    assert result(plain) == brute_force(right_rows)
    assert split.columns == ["levering", "k", "v", VOLGORDE, "v_r", "n"]


def test_right_side_may_repeat(left, right):
    """Without picking a first row the right side multiplies, in the split join as in the plain one."""
    plain, split = (left_join_all(left, [right], ON, **limits) for limits in ({}, SPLIT))
    assert plain.count() > left.count()
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_past_the_broadcast_limit(spark, left, how):
    lookup = spark.createDataFrame([("L", "hot", 1), ("L", "k1", None)], "levering string, k string, n int")
    small = lookup_join(left, lookup, ON, how)
    large = lookup_join(left, lookup, ON, how, broadcast_rows=0)
    assert small.columns == large.columns
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_keys_are_counted_once_and_bound_the_rows_per_task(spark, monkeypatch):
    """Nine tenths of the rows on one key; nothing but the rows of a key that a task may have is set."""
    monkeypatch.setattr(joins, "HOT_ROWS", 500)
    counted = []
    monkeypatch.setattr(joins, "hot_keys", lambda *a: counted.append(a) or hot_keys(*a))
    left = spark.range(10_000).selectExpr("'L' levering", "IF(id % 10 = 0, cast(id AS string), 'hot') k", "id v", f"struct(id AS blok) {VOLGORDE}")
    right = spark.createDataFrame([("L", "hot", 1), ("L", "20", 2)], "levering string, k string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = left_join_all(left, [right], ON)
        again = left_join_all(left, [right], ON)
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in per_task) < 3000 and len(counted) == 1
        assert joined.where("n = 1").count() == 9000 and joined.where("n = 2").count() == 1 and again.count() == 10_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_wide_sides_are_not_broadcast(spark, left, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_CHARS", 10)
    lookup = spark.createDataFrame([("L", "hot", "x" * 50)], "levering string, k string, n string")
    assert "BroadcastHashJoin" not in lookup_join(left, lookup, ON)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in lookup_join(left, lookup, ON)._jdf.queryExecution().optimizedPlan().toString()


def test_a_finer_key_is_not_counted_after_a_coarser_one_without_hot_keys(left, monkeypatch):
    counted = []
    monkeypatch.setattr(joins, "_counted", {})
    monkeypatch.setattr(joins, "hot_keys", lambda *a: counted.append(a[1]) or hot_keys(*a))
    assert joins.counted_hot_keys(left, ["levering"], 600) is None
    assert joins.counted_hot_keys(left, ["levering", "k"], 600) is None and counted == [["levering"]]
    # With a hot key, another limit or a key of other columns it is counted.
    assert joins.counted_hot_keys(left, ["levering"], 599).count() == 1
    assert joins.counted_hot_keys(left, ["levering", "k"], 599) is None
    assert joins.counted_hot_keys(left, ["k"], 20).count() == 2
    assert counted == [["levering"], ["levering"], ["levering", "k"], ["k"]]
