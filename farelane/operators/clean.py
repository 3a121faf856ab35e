"""Cleaning rules: each one a filter, composed by :func:`clean_trips`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.schema import COORDINATES, DEFAULT_LIMITS, LATITUDES, LONGITUDES, Limits


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def complete(df: DataFrame, skip: tuple[str, ...] = ("key",)) -> Column:
    """True where no column is null or NaN."""
    checks = []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        checks.append(F.col(field.name).isNotNull())
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            checks.append(~F.isnan(field.name))
    return _all(checks)


def in_box(names, lo: float, hi: float) -> Column:
    """Every named column within ``[lo, hi]``."""
    return _all(F.col(n).between(lo, hi) for n in names)


def rules(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> dict[str, Column]:
    """The row filters in the order they apply, by name."""
    return {
        "missing": complete(df),
        "zero_coordinates": reduce(lambda a, b: a | b, (F.col(c) != 0 for c in COORDINATES)),
        "passengers_low": F.col("passenger_count") > limits.passengers_above,
        "fare_low": F.col("fare_amount") > limits.fare_above,
        "fare_high": F.col("fare_amount") < limits.fare_below,
        "passengers_high": F.col("passenger_count") < limits.passengers_below,
        "latitude_box": in_box(LATITUDES, limits.lat_min, limits.lat_max),
        "longitude_box": in_box(LONGITUDES, limits.lon_min, limits.lon_max),
    }


def drop_key(df: DataFrame) -> DataFrame:
    """Remove the identifier, so equal trips with different keys become duplicates."""
    return df.drop("key")


def drop_duplicate_trips(df: DataFrame) -> DataFrame:
    """One row per set of equal rows, over the whole table.

    The partial aggregate folds copies inside each task before the shuffle, so a
    trip that repeats in a third of the table still sends one row per task.
    """
    return df.dropDuplicates()


def drop_missing(df: DataFrame) -> DataFrame:
    return df.filter(complete(df, skip=()))


def drop_zero_coordinates(df: DataFrame) -> DataFrame:
    """Only rows with all four coordinates zero go."""
    return df.filter(rules(df)["zero_coordinates"])


def passengers_above(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.filter(rules(df, limits)["passengers_low"])


def passengers_below(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.filter(rules(df, limits)["passengers_high"])


def fare_above(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.filter(rules(df, limits)["fare_low"])


def fare_below(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.filter(rules(df, limits)["fare_high"])


def in_latitude_box(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.filter(rules(df, limits)["latitude_box"])


def in_longitude_box(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    return df.filter(rules(df, limits)["longitude_box"])


def in_bbox(df: DataFrame, lon_min: float, lon_max: float, lat_min: float, lat_max: float) -> DataFrame:
    """Trips with both ends inside the box, edges included."""
    return df.filter(in_box(LONGITUDES, lon_min, lon_max) & in_box(LATITUDES, lat_min, lat_max))


def filter_trips(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Every row filter, no duplicate removal: a narrow step for batch and stream."""
    kept = drop_key(df)
    return kept.filter(_all(rules(kept, limits).values()))


def clean_trips(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Drop the key, apply every filter, then remove duplicates.

    The filters look only at columns the duplicates share, so filtering first gives
    the same rows and shuffles fewer of them.
    """
    return drop_duplicate_trips(filter_trips(df, limits))


def cleaning_report(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """``(step, rule, rejected, remaining)``: what each rule alone rejects of the raw
    rows, and how many rows are left after it in sequence.

    One pass: equal rows are folded with their count, then every figure is a
    conditional sum over the folded rows.
    """
    trips = drop_key(df)
    folded = trips.groupBy(*trips.columns).agg(F.count("*").alias("copies"))
    checks = {name: F.coalesce(c, F.lit(False)) for name, c in rules(trips, limits).items()}

    figures = [
        F.struct(F.lit(0).alias("step"), F.lit("raw").alias("rule"), F.lit(0).cast("long").alias("rejected"),
                 F.coalesce(F.sum("copies"), F.lit(0)).alias("remaining")),
        F.struct(F.lit(1).alias("step"), F.lit("duplicates").alias("rule"),
                 F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("rejected"),
                 F.count("*").alias("remaining")),
    ]
    so_far = F.lit(True)
    for step, (name, keep) in enumerate(checks.items(), start=2):
        so_far = so_far & keep
        figures.append(
            F.struct(
                F.lit(step).alias("step"),
                F.lit(name).alias("rule"),
                F.coalesce(F.sum(F.when(~keep, F.col("copies"))), F.lit(0)).alias("rejected"),
                F.count_if(so_far).alias("remaining"),
            )
        )
    return folded.agg(F.array(*figures).alias("figures")).select(F.inline("figures"))
