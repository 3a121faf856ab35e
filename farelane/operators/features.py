"""The fixed 65-feature projection: a pure function of the row, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions import cell_id, cell_number, cell_text, haversine_km, manhattan_km
from farelane.functions import clock_date, clock_hour, cyclic_hour, local_clock, weekday
from farelane.schema import (
    CELLS_20,
    CITY_ZONE,
    DISTANCE_RANGE,
    FEATURE_COLUMNS,
    MONTHS,
    PASSENGER_RANGE,
    TARGET_COLUMN,
    WEEKDAYS,
    YEAR_RANGE,
)


def _ends() -> tuple[Column, Column, Column, Column]:
    return (
        F.col("pickup_latitude"),
        F.col("pickup_longitude"),
        F.col("dropoff_latitude"),
        F.col("dropoff_longitude"),
    )


def with_distances(df: DataFrame) -> DataFrame:
    """Add ``haversine_km`` and ``manhattan_km``."""
    return df.withColumns({"haversine_km": haversine_km(*_ends()), "manhattan_km": manhattan_km(*_ends())})


def with_distance(df: DataFrame) -> DataFrame:
    """Add the single ``distance`` column (manhattan) of the baseline models."""
    return df.withColumn("distance", manhattan_km(*_ends()))


def with_cells(df: DataFrame, precision: int = 5) -> DataFrame:
    """Add ``pickup_cell`` and ``dropoff_cell`` as geohash text."""
    lat1, lon1, lat2, lon2 = _ends()
    ids = df.withColumns({"__p": cell_id(lat1, lon1, precision), "__d": cell_id(lat2, lon2, precision)})
    return ids.withColumns(
        {"pickup_cell": cell_text(F.col("__p"), precision), "dropoff_cell": cell_text(F.col("__d"), precision)}
    ).drop("__p", "__d")


def time_features(df: DataFrame, tz: str = CITY_ZONE) -> DataFrame:
    """Add ``hour_sin, hour_cos, dow, month, year`` of the local pickup time."""
    local = df.withColumn("__local", local_clock(F.col("pickup_datetime"), tz))
    parts = local.withColumns({"__hour": clock_hour(F.col("__local")), "__day": clock_date(F.col("__local"))})
    hour_sin, hour_cos = cyclic_hour(F.col("__hour"))
    return parts.withColumns(
        {
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "dow": weekday(F.col("__day")),
            "month": F.month("__day"),
            "year": F.year("__day"),
        }
    ).drop("__local", "__hour", "__day")


def trip_features(
    df: DataFrame,
    cells: Sequence[str] = CELLS_20,
    keep: Sequence[str] = (),
    target: bool = False,
) -> DataFrame:
    """Turn trips into the feature columns ``_0``, ``_1``, ...

    Stacked projections: local time, distances and cell ids are computed once per
    row, the last projection spells out the columns from them. With 20 cells there are 65
    columns; ``target`` appends the fare as the last one. ``keep`` names input
    columns to carry along in front.
    """
    precision = len(cells[0])
    lat1, lon1, lat2, lon2 = _ends()
    base = df.select(
        *keep,
        *([F.col("fare_amount").alias("__fare")] if target else []),
        F.col("passenger_count").alias("__passengers"),
        local_clock(F.col("pickup_datetime")).alias("__local"),
        haversine_km(lat1, lon1, lat2, lon2).alias("__haversine"),
        manhattan_km(lat1, lon1, lat2, lon2).alias("__manhattan"),
        cell_id(lat1, lon1, precision).alias("__pickup"),
        cell_id(lat2, lon2, precision).alias("__dropoff"),
    )
    # -1 stands for "no category": columns that cannot be null keep the generated code
    # of the wide projection short
    day = clock_date(F.col("__local"))
    base = base.withColumns(
        {
            "__dow": F.coalesce(weekday(day), F.lit(-1)),
            "__month": F.coalesce(F.month(day), F.lit(-1)),
            "__year": F.year(day),
            "__pickup": F.coalesce("__pickup", F.lit(-1)),
            "__dropoff": F.coalesce("__dropoff", F.lit(-1)),
        }
    )
    hour_sin, hour_cos = cyclic_hour(clock_hour(F.col("__local")))
    base = base.withColumns({"__sin": hour_sin, "__cos": hour_cos})

    def scaled(name: str, bounds: tuple[int, int]) -> str:
        return f"({name} - {bounds[0]}D) / {bounds[1] - bounds[0]}D"

    def flags(name: str, values) -> list[str]:
        return [f"{name} = {v}" for v in values]

    # SQL text: one call to the driver's JVM for all columns instead of several per column
    ids = [cell_number(c) for c in cells]
    columns = [
        scaled("__passengers", PASSENGER_RANGE),
        *flags("__dow", WEEKDAYS),
        *flags("__month", MONTHS),
        scaled("__year", YEAR_RANGE),
        "__sin",
        "__cos",
        scaled("__haversine", DISTANCE_RANGE),
        scaled("__manhattan", DISTANCE_RANGE),
        *flags("__pickup", ids),
        *flags("__dropoff", ids),
        *(["__fare"] if target else []),
    ]
    return base.selectExpr(*(f"`{k}`" for k in keep), *(f"CAST({c} AS FLOAT) AS _{i}" for i, c in enumerate(columns)))


def with_target(df: DataFrame, cells: Sequence[str] = CELLS_20) -> DataFrame:
    """Features and, as the last column, the fare: one projection, never a join."""
    return trip_features(df, cells, target=True)


def split_target(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trips without the fare, and the fare alone."""
    return df.drop("fare_amount"), df.select("fare_amount")


def to_vector(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = TARGET_COLUMN) -> DataFrame:
    """``features`` vector (and ``label`` when present) for ``pyspark.ml``."""
    out = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(df)
    extra = [c for c in df.columns if c not in set(features) and c != label]
    if label in df.columns:
        return out.select(*extra, "features", F.col(label).cast("double").alias("label"))
    return out.select(*extra, "features")
