"""Left joins against tables with at most a few rows per key, safe for small, large and hot keys.

A side is broadcast only after its rows and bytes were counted. Beyond that the join shuffles. Keys of the left side are
counted, once for each table and key; those with more than ``HOT_ROWS`` rows are split over several tasks and the
matching right rows are copied to each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlake.columns import VOLGORDE

# A counted side of at most this many rows and characters is broadcast.
BROADCAST_ROWS = 300_000
BROADCAST_CHARS = 100 << 20
# Rows of one key that a single task takes; a table of n rows has at most n / HOT_ROWS keys above it.
HOT_ROWS = 5_000_000

_KEY_HASH = "_sleutel"
_SLICES = "_delen"
_SLICE = "_deel"
_NULL_SLICES = 1024


def all_filled(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def finest_first(on: Sequence[str]) -> list[str]:
    """Columns of a key for joins, groups and windows. Sorting compares the first eight bytes of the first column and goes on to
    whole rows where they are equal, as they are for most rows of a delivery. All take this order, so they share a shuffle.
    """
    return list(reversed(on))


def first_per_key(df: DataFrame, on: Sequence[str], order: str = VOLGORDE) -> DataFrame:
    """First row per key in delivery order. Rows with a null in the key go: they match nothing in a join.

    ``row_number() = 1`` keeps one row per key and task before the shuffle, so a hot key stays small.
    """
    window = Window.partitionBy(*finest_first(on)).orderBy(order)
    numbered = df.where(all_filled(on)).withColumn("_rij", F.row_number().over(window))
    return numbered.where(F.col("_rij") == 1).drop("_rij")


def counted_side(df: DataFrame) -> tuple[int, int]:
    """Rows of a table and the characters in its columns."""
    sizes = [F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c in df.columns if c != VOLGORDE]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(reduce(lambda x, y: x + y, sizes, F.lit(0))).alias("m")).first()
    return row.n, row.m or 0


def hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys above ``hot_rows`` rows with the number of slices to cut them into; at most rows / hot_rows of them.

    Rows with a null in the key count too: they match nothing, but a plain shuffle would put them in one task.
    """
    counts = df.groupBy(F.xxhash64(*on).alias(_KEY_HASH)).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > hot_rows).select(
        _KEY_HASH, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias(_SLICES)
    )


_counted: dict[tuple, tuple[DataFrame, DataFrame | None]] = {}


def counted_hot_keys(df: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame | None:
    """``hot_keys`` of a table, or None without any. A table is counted once per key; its counts combine in the tasks
    that read it, so only one row per key and task is shuffled. Where it was counted by some of the columns and no key was
    hot, none is by more columns: their rows are part of the rows of one of those keys, with nulls as with values."""
    known = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), tuple(on), hot_rows)
    for (application, table, columns, limit), (counted, hot) in _counted.items():
        coarser = (application, table, limit) == (known[0], known[1], hot_rows) and set(columns) < set(on)
        if coarser and hot is None and counted.sameSemantics(df):
            return None
    if known not in _counted or not _counted[known][0].sameSemantics(df):
        found = hot_keys(df, on, hot_rows).collect()  # rows / hot_rows of them at most
        hot = df.sparkSession.createDataFrame(found, f"{_KEY_HASH} long, {_SLICES} int") if found else None
        if len(_counted) >= 100:
            _counted.clear()
        _counted[known] = df, hot
    return _counted[known][1]


def split_hot_keys(
    left: DataFrame, rights: Sequence[DataFrame], on: Sequence[str], hot: DataFrame, order: str = VOLGORDE
) -> tuple[DataFrame, list[DataFrame]]:
    """Add a slice column to both sides: hot left rows are spread, right rows are copied to every slice of their key.

    The slice comes from the row's fixed position, so a recomputed task puts every row in the same slice again.
    """
    position = F.xxhash64(order)
    sliced = (
        left.withColumn(_KEY_HASH, F.xxhash64(*on))
        .join(F.broadcast(hot), _KEY_HASH, "left")
        .withColumn(
            _SLICE,
            F.when(all_filled(on), F.pmod(position, F.coalesce(_SLICES, F.lit(1))))
            .otherwise(-1 - F.pmod(position, F.lit(_NULL_SLICES)))
            .cast("int"),
        )
        .drop(_KEY_HASH, _SLICES)
    )
    copies = [
        right.withColumn(_KEY_HASH, F.xxhash64(*on))
        .join(F.broadcast(hot), _KEY_HASH, "left")
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(_SLICES, F.lit(1)) - 1)))
        .drop(_KEY_HASH, _SLICES)
        for right in rights
    ]
    return sliced, copies


def without_collisions(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    """Rename right columns that also exist on the left."""
    taken = set(left.columns) - set(on)
    return right.withColumnsRenamed({c: f"{c}{suffix}" for c in right.columns if c in taken and c not in on})


def left_join_all(
    left: DataFrame,
    rights: Sequence[DataFrame],
    on: Sequence[str],
    suffix: str = "_r",
    hot_rows: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Left join ``left`` with each of ``rights`` on the same key; the wide side is shuffled once for all of them.

    ``keys_from`` has the keys of ``left`` row for row but is cheaper to count, such as the table it was made from.
    """
    keys = finest_first(on)
    hot = counted_hot_keys(left if keys_from is None else keys_from, on, hot_rows or HOT_ROWS)
    if hot is not None:
        left, rights = split_hot_keys(left, rights, on, hot)
        keys.append(_SLICE)
    columns = left.columns
    for right in rights:
        added = without_collisions(left, right.drop(VOLGORDE), keys, suffix)
        columns += [c for c in added.columns if c not in keys]
        left = left.join(added, keys, "left")
    return left.select(*[c for c in columns if c != _SLICE])


def keep_first_left_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_r", **limits: int
) -> DataFrame:
    """Left join with the first right row per key; the left grain stays as it is."""
    return left_join_all(left, [first_per_key(right, on)], on, suffix, **limits)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    right_rows: int | None = None,
    suffix: str = "_r",
    broadcast_rows: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join with a table of one row per delivery: broadcast when its counted rows and characters allow, sliced shuffle
    otherwise. ``right_rows`` says how many it has, if that is known and its columns are short."""
    rows, chars = (right_rows, 0) if right_rows is not None else counted_side(right)
    if rows <= (BROADCAST_ROWS if broadcast_rows is None else broadcast_rows) and chars <= BROADCAST_CHARS:
        added = without_collisions(left, right.drop(VOLGORDE), on, suffix)
        columns = [*left.columns, *[c for c in added.columns if c not in on]]
        return left.join(F.broadcast(added), list(on), how).select(*columns)
    joined = left_join_all(left, [right.withColumn("_gevonden", F.lit(True))], on, suffix, keys_from=keys_from)
    return (joined.where("_gevonden") if how == "inner" else joined).drop("_gevonden")
