"""Trip-shaped relations derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions import clock_seconds

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def trips_from_events(events: DataFrame) -> DataFrame:
    """Raw trips, one per event plus an exact copy of every 50th.

    Integer arithmetic on the event id places the ends and breaks some rows on
    purpose: missing, negative and excessive fares, zero and far-off coordinates.
    Works on batch and streaming input and reads the source once.
    """
    i = F.col("event_id")
    steps = events.select(
        i.alias("i"),
        "ts",
        "value",
        ((i * 7919) % 2500).alias("px"),
        ((i * 104729) % 2000).alias("py"),
        ((i * 15485863) % 2500).alias("dx"),
        ((i * 32452843) % 2000).alias("dy"),
    )
    # The trip is built inside the generator: a filter on a trip column then tests the
    # finished value instead of repeating the CASE expressions in the scan's filter.
    return steps.selectExpr(
        """inline(array_repeat(named_struct(
             'key', CAST(i AS STRING),
             'fare_amount',
               CASE WHEN i % 101 = 3 THEN NULL
                    WHEN i % 103 = 4 THEN -value
                    WHEN i % 107 = 8 THEN 400e0 + value
                    ELSE (250 + 2 * abs(dx - px) + 2 * abs(dy - py)) / 1e2 + value / 2e1 END,
             'pickup_datetime', ts - make_dt_interval(CAST(1500 + (i * 37) % 4000 AS INT)),
             'pickup_longitude', CASE WHEN i % 89 = 5 THEN 0e0 ELSE -74.02e0 + px / 1e4 END,
             'pickup_latitude', CASE WHEN i % 89 = 5 THEN 0e0 ELSE 40.60e0 + py / 1e4 END,
             'dropoff_longitude',
               CASE WHEN i % 89 = 5 THEN 0e0 WHEN i % 97 = 6 THEN -75e0 ELSE -74.02e0 + dx / 1e4 END,
             'dropoff_latitude', CASE WHEN i % 89 = 5 THEN 0e0 ELSE 40.60e0 + dy / 1e4 END,
             'passenger_count', CAST((i * 31) % 10 AS INT)
           ), CASE WHEN i % 50 = 7 THEN 2 ELSE 1 END))"""
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same file as a stream source."""
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(folder)


def raw_trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_from_events(read_events(spark, folder))


def trips_as_text(trips: DataFrame) -> DataFrame:
    """Trips the way a text file holds them, with some unreadable times."""
    number = F.col("key").cast("long")
    stamp = F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    return trips.withColumn(
        "pickup_datetime",
        F.when(number % 211 == 9, "not a time").when(number % 3 == 0, stamp).otherwise(F.concat(stamp, F.lit(" UTC"))),
    )


def requests_from_events(events: DataFrame) -> DataFrame:
    """Prediction requests in New York wall time; a third each falls around a spring
    and an autumn clock change."""
    trips = trips_from_events(events).withColumn("request_id", F.col("key").cast("long"))
    i = F.col("request_id")
    minutes = (i * 7) % 300
    spring = F.timestamp_add("MINUTE", minutes, F.lit("2013-03-10 00:00:00").cast("timestamp_ntz"))
    autumn = F.timestamp_add("MINUTE", minutes, F.lit("2013-11-03 00:00:00").cast("timestamp_ntz"))
    whole = F.timestamp_add("SECOND", clock_seconds(F.col("pickup_datetime")), F.lit("1970-01-01").cast("timestamp_ntz"))
    when = F.when(i % 3 == 0, spring).when(i % 3 == 1, autumn).otherwise(whole)
    return trips.select(
        "request_id",
        when.alias("pickup_datetime"),
        "pickup_longitude",
        "pickup_latitude",
        "dropoff_longitude",
        "dropoff_latitude",
        "passenger_count",
    )
