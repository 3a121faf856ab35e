"""Geohash districts: frequency, top list, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.functions import cell_id, cell_text


def _end_ids(df: DataFrame, precision: int) -> DataFrame:
    """Pickup and dropoff cell ids stacked, from one scan."""
    return df.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(end).alias("trip_end"),
                        cell_id(F.col(f"{end}_latitude"), F.col(f"{end}_longitude"), precision).alias("id"),
                    )
                    for end in ("pickup", "dropoff")
                )
            )
        )
    )


def trip_end_cells(df: DataFrame, precision: int = 5) -> DataFrame:
    """Two rows per trip, ``(trip_end, cell)``."""
    return _end_ids(df, precision).select("trip_end", cell_text(F.col("id"), precision).alias("cell"))


def district_counts(df: DataFrame, precision: int = 5) -> DataFrame:
    """Trip ends per district ``(cell, n)``, pickup and dropoff together.

    Groups by the integer id; the text is made once per district.
    """
    counts = _end_ids(df, precision).groupBy("id").agg(F.count("*").alias("n"))
    return counts.select(cell_text(F.col("id"), precision).alias("cell"), "n")


def distinct_districts(df: DataFrame, precision: int = 5) -> DataFrame:
    """How many different districts trips start or end in."""
    ids = _end_ids(df, precision).groupBy("id").agg(F.lit(1))
    return ids.agg(F.count("id").alias("districts"))


def top_districts(df: DataFrame, k: int = 20, precision: int = 5) -> DataFrame:
    """The ``k`` most frequent districts, ties broken by name."""
    return district_counts(df, precision).orderBy(F.desc("n"), "cell").limit(k)


def coverage(df: DataFrame, k: int = 20, precision: int = 5) -> DataFrame:
    """Share of all trip ends covered by the first 1, 2, .. ``k`` districts, in percent.

    Top list and total come from the same aggregate; the running sum has ``k`` rows.
    """
    counts = district_counts(df, precision)
    total = counts.agg(F.sum("n")).scalar()
    top = counts.orderBy(F.desc("n"), "cell").limit(k)
    order = Window.orderBy(F.desc("n"), "cell")
    running = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return top.select(
        F.row_number().over(order).alias("rank"), "cell", "n", (running / total * 100).alias("covered_pct")
    )


def derive_cells(df: DataFrame, k: int = 20, precision: int = 5) -> list[str]:
    """The top districts as a list, to use as the one-hot categories of ``trip_features``."""
    return [row.cell for row in top_districts(df, k, precision).collect()]
