"""Shrink numeric columns to the smallest type that holds their values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_NAMES = {8: "tinyint", 16: "smallint", 32: "int", 64: "bigint"}
FLOAT_TOLERANCE = 5e-4  # largest change a double may suffer as float


def downcast_plan(df: DataFrame) -> DataFrame:
    """``(column, type, suggested, rows, bytes_before, bytes_after)`` per numeric column, in one pass.

    Integers shrink by range; a double becomes a float when no value moves by more
    than the tolerance.
    """
    lines = []
    for field in df.schema.fields:
        x = F.col(field.name)
        kind = type(field.dataType)
        if kind in _BITS:
            width = _BITS[kind]
            suggested = F.lit(_NAMES[width])
            after = F.lit(width // 8)
            for bits in sorted((b for b in _NAMES if b < width), reverse=True):
                fits = (F.min(x) >= F.lit(-(2 ** (bits - 1)))) & (F.max(x) <= F.lit(2 ** (bits - 1) - 1))
                suggested = F.when(fits, F.lit(_NAMES[bits])).otherwise(suggested)
                after = F.when(fits, F.lit(bits // 8)).otherwise(after)
            before = width // 8
        elif kind is T.DoubleType:
            moved = F.abs(x - x.cast("float").cast("double"))
            fits = F.coalesce(F.max(F.when(~F.isnan(moved), moved)), F.lit(0.0)) <= F.lit(FLOAT_TOLERANCE)
            suggested = F.when(fits, F.lit("float")).otherwise(F.lit("double"))
            after = F.when(fits, F.lit(4)).otherwise(F.lit(8))
            before = 8
        else:
            continue
        rows = F.count("*")
        lines.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                suggested.alias("suggested"),
                rows.alias("rows"),
                (rows * before).alias("bytes_before"),
                (rows * after).alias("bytes_after"),
            )
        )
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def apply_downcast(df: DataFrame, plan: DataFrame) -> DataFrame:
    """Cast every column to its suggested type; ``plan`` has one row per column."""
    target = {row.column: row.suggested for row in plan.select("column", "suggested").collect()}
    return df.select(*(F.col(c).cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns))
