"""Union by column name under schema drift."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.columns import BRON

_WIDTH = {T.ByteType(): 0, T.ShortType(): 1, T.IntegerType(): 2, T.LongType(): 3}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type that holds both: text wins over everything, floats over integers, wide over narrow."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WIDTH and b in _WIDTH:
        return max(a, b, key=_WIDTH.__getitem__)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def merged_schema(frames: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """Columns in first-seen order with the type that fits every frame."""
    merged: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            merged[field.name] = common_type(merged.get(field.name, field.dataType), field.dataType)
    return merged


def relaxed_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; a missing column is null, differing types meet in ``common_type``."""
    schema = merged_schema(frames)

    def conform(frame: DataFrame) -> DataFrame:
        have = dict(frame.dtypes)
        return frame.select(
            *[
                (F.col(f"`{name}`") if name in have else F.lit(None)).cast(dtype).alias(name)
                for name, dtype in schema.items()
            ]
        )

    return reduce(DataFrame.unionAll, map(conform, frames))


def tagged_union(frames: dict[str, DataFrame], column: str = BRON) -> DataFrame:
    """Relaxed union with the source name of every row in ``column``."""
    return relaxed_union([frame.withColumn(column, F.lit(name)) for name, frame in frames.items()])
