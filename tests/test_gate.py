"""Streams with state: copies within the delay, late rows, windows that close, restarts and crashes."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from farelane.operators.clean import drop_duplicate_trips
from farelane.schema import RAW
from farelane.streaming import gate
from farelane.streaming.trips import read_landed

START = datetime(2013, 7, 6, 12)


def rows(df):
    return sorted(map(repr, df.collect()))


def at(hours, **more):
    return {"pickup_datetime": START + timedelta(hours=hours), **more}


class Line:
    """A scorer: the prediction is always 10."""

    def __call__(self, df):
        return df.withColumn("prediction", F.lit(10.0))


@pytest.fixture()
def feed(spark, trips, tmp_path):
    """Adds arrivals, one batch each, and opens the stream over all of them."""
    path = str(tmp_path / "in")

    def add(*changes):
        trips(*changes).coalesce(1).write.mode("append").parquet(path)

    def stream():
        return spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(path)

    add.path = path
    return add, stream


def test_copies_within_the_delay_equal_batch(spark, feed, tmp_path):
    add, stream = feed
    add(at(0), at(0, key="b"), at(5), at(5, passenger_count=2))
    add(at(5, key="copy"), at(20), at(0))  # the watermark is 19 hours before the first
    add(at(20), at(30), at(8, fare_amount=None), at(8, fare_amount=None))
    path = str(tmp_path / "out")
    gate.dedup_within(stream(), path, str(tmp_path / "state"), "24 hours").awaitTermination()
    whole = spark.read.schema(RAW).parquet(add.path)
    assert rows(gate.read_within(spark, path, RAW)) == rows(drop_duplicate_trips(whole.drop("key")).select(RAW.names[1:]))
    assert spark.read.parquet(f"{path}/closed").count() == 6
    assert read_landed(spark, f"{path}/late", RAW).count() == 0


def test_late_trips_are_landed_once(spark, feed, tmp_path):
    add, stream = feed
    nothing = {"pickup_datetime": None}
    add(at(0), at(100))
    add(at(0, key="late copy"), at(1), at(1), at(100), at(200), nothing)  # behind 100 - 24
    add(at(1), at(150), at(2), nothing)
    path = str(tmp_path / "out")
    for state in ("a", "a", "b"):  # "b" starts without a checkpoint and replays every batch
        gate.dedup_within(stream(), path, str(tmp_path / state), "24 hours").awaitTermination()
        whole = spark.read.schema(RAW).parquet(add.path)
        got = gate.read_within(spark, path, RAW)
        if state == "a":
            assert rows(got) == rows(drop_duplicate_trips(whole.drop("key")).select(RAW.names[1:]))
    add(at(150), at(151), at(3), at(300))
    gate.dedup_within(stream(), path, str(tmp_path / "a"), "24 hours").awaitTermination()
    whole = spark.read.schema(RAW).parquet(add.path)
    assert rows(gate.read_within(spark, path, RAW).distinct()) == rows(drop_duplicate_trips(whole.drop("key")).select(RAW.names[1:]))


def _windows(spark, path, size="10 hours"):
    df = spark.read.schema(RAW).parquet(path).filter("pickup_datetime IS NOT NULL")
    parts = df.groupBy(F.window(F.col("pickup_datetime").cast("timestamp"), size).alias("w")).agg(F.avg(F.abs(10 - F.col("fare_amount"))).alias("mae"), F.count("*").alias("n"))
    return {r.w.start: (round(r.mae, 9), r.n) for r in parts.collect()}


def _found(df):
    return {r.window_start: (round(r.mae, 9), r.rows) for r in df.collect()}


def test_windows_close_once_and_late_trips_correct_them(spark, feed, tmp_path):
    add, stream = feed
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: gate.error_windows(stream(), Line(), path, state, "10 hours", "5 hours").awaitTermination()
    add(at(0, fare_amount=12.0), at(1, fare_amount=15.0), at(11, fare_amount=9.0))
    run()
    assert _found(gate.read_windows(spark, path, state)) == _windows(spark, add.path)
    assert _found(gate.read_windows(spark, path, state, flush=False)) == {}
    add(at(30, fare_amount=20.0), at(2, fare_amount=11.0), at(12, fare_amount=30.0))  # all windows still open
    add(at(3, fare_amount=40.0), at(31, fare_amount=21.0))  # the first window has closed
    run()  # goes on from its checkpoint
    run()
    merged = gate.read_windows(spark, path, state)
    assert _found(merged) == _windows(spark, add.path)
    assert merged.agg(F.sum("corrections")).first()[0] == 1
    closed = _found(gate.read_windows(spark, path, state, flush=False))
    assert closed and closed.items() < _windows(spark, add.path).items()
    add(at(100, fare_amount=7.0))
    run()
    assert _found(gate.read_windows(spark, path, state)) == _windows(spark, add.path)


def test_a_crash_before_the_state_query_loses_and_repeats_nothing(spark, feed, tmp_path, monkeypatch):
    add, stream = feed
    path, state = str(tmp_path / "out"), str(tmp_path / "state")
    run = lambda: gate.error_windows(stream(), Line(), path, state, "10 hours", "5 hours").awaitTermination()
    add(at(0, fare_amount=12.0), at(40, fare_amount=15.0))
    run()
    add(at(1, fare_amount=12.0), at(41, fare_amount=16.0), at(90, fare_amount=12.0))

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    reader, source = type(spark).readStream, stream()
    monkeypatch.setattr(type(spark), "readStream", property(crash))  # rows and mark are written, the state query does not start
    with pytest.raises(StreamingQueryException):
        gate.error_windows(source, Line(), path, state, "10 hours", "5 hours").awaitTermination()
    monkeypatch.setattr(type(spark), "readStream", reader)
    run()
    merged = gate.read_windows(spark, path, state)
    assert _found(merged) == _windows(spark, add.path)
    assert merged.agg(F.sum("corrections")).first()[0] == 1
