"""Table layouts and the fixed numbers every step agrees on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Coordinates and fares are doubles on purpose: a float32 40.9 is not <= 40.9D,
# so float columns would lose trips that lie exactly on the bounding box.
RAW = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
    ]
)

# The same table as text files hold it: time as text, passengers in one byte.
RAW_TEXT = T.StructType(
    [
        T.StructField(f.name, {"pickup_datetime": T.StringType(), "passenger_count": T.ByteType()}.get(f.name, f.dataType))
        for f in RAW.fields
    ]
)

N_FEATURES = 65
FEATURE_COLUMNS = [f"_{i}" for i in range(N_FEATURES)]
TARGET_COLUMN = f"_{N_FEATURES}"
PROCESSED = T.StructType([T.StructField(c, T.FloatType()) for c in [*FEATURE_COLUMNS, TARGET_COLUMN]])

REQUESTS = T.StructType(
    [
        T.StructField("request_id", T.LongType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),  # New York wall time
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("passenger_count", T.IntegerType()),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("context", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

MODELS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),  # micro-batch it comes from
        T.StructField("seq", T.IntegerType()),  # number of the change of stage
    ]
)

COORDINATES = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
LONGITUDES = ("pickup_longitude", "dropoff_longitude")
LATITUDES = ("pickup_latitude", "dropoff_latitude")

CITY_ZONE = "America/New_York"

# The scaling ranges of the feature set.
PASSENGER_RANGE = (1, 8)
DISTANCE_RANGE = (0, 100)
YEAR_RANGE = (2009, 2019)
WEEKDAYS = tuple(range(7))
MONTHS = tuple(range(1, 13))

# The 20 precision-5 districts that are one-hot encoded, in column order.
CELLS_20 = (
    "dr5ru", "dr5rs", "dr5rv", "dr72h", "dr72j", "dr5re", "dr5rk", "dr5rz", "dr5ry", "dr5rt",
    "dr5rg", "dr5x1", "dr5x0", "dr72m", "dr5rm", "dr5rx", "dr5x2", "dr5rw", "dr5rh", "dr5x8",
)

# Names a sized dataset may have, and the months the feed offers.
SIZES = ("1k", "10k", "100k", "500k", "50M", "new")
FEED_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun")


@dataclass(frozen=True)
class Limits:
    """Bounds of the cleaning rules; fares and passengers exclusive, boxes inclusive."""

    fare_above: float = 0.0
    fare_below: float = 400.0
    passengers_above: int = 0
    passengers_below: int = 8
    lat_min: float = 40.5
    lat_max: float = 40.9
    lon_min: float = -74.3
    lon_max: float = -73.7


DEFAULT_LIMITS = Limits()
