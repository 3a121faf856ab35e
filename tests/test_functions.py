import math
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farelane import functions as fn
from farelane.operators import features, profile
from farelane.schema import CELLS_20



def bisect_hash(lat, lon, precision):
    """Geohash by halving the ranges; a point on the middle goes to the lower half."""
    spans = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}
    number = 0
    for i in range(5 * precision):
        span, x = spans[i % 2], (lon, lat)[i % 2]
        mid = (span[0] + span[1]) / 2
        number = number * 2 + (x > mid)
        span[0 if x > mid else 1] = mid
    text = ""
    for _ in range(precision):
        text = "0123456789bcdefghjkmnpqrstuvwxyz"[number % 32] + text
        number //= 32
    return text


def test_golden_trip(trips):
    row = features.with_distances(features.with_cells(trips({}))).first()
    assert (row.pickup_cell, row.dropoff_cell) == ("dr72j", "dr5ru")
    assert row.haversine_km == pytest.approx(3.209961648, abs=1e-9)
    assert row.manhattan_km == pytest.approx(5.247288589, abs=1e-9)
    timed = features.time_features(trips({})).first()
    assert (timed.dow, timed.month, timed.year) == (5, 7, 2013)
    assert timed.hour_sin == pytest.approx(math.sin(2 * math.pi * 13 / 24))
    assert timed.hour_cos == pytest.approx(math.cos(2 * math.pi * 13 / 24))


coordinates = st.tuples(
    st.floats(-90, 90) | st.integers(-90, 90).map(float) | st.sampled_from([0.0, 5e-324, 45.0, 40.78125]),
    st.floats(-180, 180) | st.integers(-180, 180).map(float) | st.sampled_from([0.0, 5e-324, -74.00390625, 1e-16]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(points=st.lists(coordinates, min_size=20, max_size=60), precision=st.integers(1, 12))
def test_geohash_equals_bisection(spark, points, precision):
    df = spark.createDataFrame(points, "lat double, lon double")
    found = df.select("lat", "lon", fn.geohash(F.col("lat"), F.col("lon"), precision).alias("g")).collect()
    for row in found:
        assert row.g == bisect_hash(row.lat, row.lon, precision)


def test_geohash_of_null_is_null(spark):
    df = spark.createDataFrame([(None, -74.0), (40.7, None)], "lat double, lon double")
    assert [r[0] for r in df.select(fn.geohash(F.col("lat"), F.col("lon"))).collect()] == [None, None]


def test_cell_number_matches_cell_id(spark):
    assert len({fn.cell_number(c) for c in CELLS_20}) == 20
    df = spark.createDataFrame([(fn.cell_number(c), c) for c in CELLS_20], "id long, c string")
    assert all(r.t == r.c for r in df.select("c", fn.cell_text(F.col("id")).alias("t")).collect())


def test_haversine_of_antipodes(spark):
    df = spark.createDataFrame([(10.0, 20.0, -10.0, -160.0)], "a double, b double, c double, d double")
    km = df.select(fn.haversine_km(*(F.col(c) for c in "abcd"))).first()[0]
    assert km == pytest.approx(math.pi * 6371, abs=1e-3)


@pytest.mark.parametrize(
    ("text", "expected", "strict"),
    [
        ("2013-07-06 17:18:00 UTC", datetime(2013, 7, 6, 17, 18), True),
        ("2013-07-06 17:18:00", datetime(2013, 7, 6, 17, 18), False),
        ("2013-07-06T17:18:00Z", datetime(2013, 7, 6, 17, 18), False),
        ("2013-07-06 17:18:00+02:00", datetime(2013, 7, 6, 15, 18), False),
        ("2013-07-06 17:18:00.250000", datetime(2013, 7, 6, 17, 18, 0, 250000), False),
        ("2013-07-06", datetime(2013, 7, 6), False),
        ("06 July", None, False),
        ("", None, False),
        (None, None, False),
    ],
)
def test_parse_utc(spark, text, expected, strict):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(fn.parse_utc(F.col("t")).alias("p"), fn.parse_utc(F.col("t"), strict=True).alias("s")).first()
    assert row.p == expected
    assert row.s == (expected if strict else None)


WALL = [
    ("2013-03-10 01:59:00", "ok", "2013-03-10 06:59:00"),
    ("2013-03-10 02:30:00", "nonexistent", None),
    ("2013-03-10 03:00:00", "ok", "2013-03-10 07:00:00"),
    ("2013-11-03 00:59:00", "ok", "2013-11-03 04:59:00"),
    ("2013-11-03 01:30:00", "ambiguous", None),
    ("2013-11-03 02:00:00", "ok", "2013-11-03 07:00:00"),
    ("2013-07-06 17:18:00", "ok", "2013-07-06 21:18:00"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(w,) for w, _, _ in WALL], "w string")
        wall = F.col("w").cast("timestamp_ntz")
        found = df.select(
            fn.local_status(wall).alias("status"),
            fn.format_utc(fn.local_to_utc(wall)).alias("utc"),
            fn.parse_utc(F.concat("w", F.lit(" UTC"))).cast("string").alias("parsed"),
            fn.to_local(fn.local_to_utc(wall)).cast("string").alias("back"),
            F.unix_micros(fn.to_instant(wall)).alias("us"),
        ).collect()
        for row, (w, status, utc) in zip(found, WALL):
            assert row.status == status
            assert row.parsed == w
            assert row.us == (datetime.fromisoformat(w) - datetime(1970, 1, 1)).total_seconds() * 1e6
            if utc:
                assert row.utc == f"{utc} UTC"
                assert row.back == w
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_missing_wall_time(spark):
    df = spark.createDataFrame([(None,)], "w timestamp_ntz")
    assert df.select(fn.local_status(F.col("w"))).first()[0] == "missing"


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([(f"2024-01-0{d}",) for d in range(1, 8)], "d string")
    assert [r[0] for r in df.select(fn.weekday(F.col("d").cast("date"))).collect()] == list(range(7))


def test_one_hot_unknown_and_null_are_zero(spark):
    df = spark.createDataFrame([("x",), ("q",), (None,)], "c string")
    found = df.select(*fn.one_hot(F.col("c"), ["x", "y"], "is_")).collect()
    assert [tuple(r) for r in found] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]
    assert found[0].asDict().keys() == {"is_x", "is_y"}


def test_dataset_month(trips):
    early, late = {"pickup_datetime": "2013-05-09 10:00:00"}, {"pickup_datetime": "2015-03-31 23:59:59"}
    assert str(profile.dataset_month(trips(early)).first()[0]) == "2014-12-01"
    assert str(profile.dataset_month(trips(early), floor=None).first()[0]) == "2013-05-01"
    assert str(profile.dataset_month(trips(early, late)).first()[0]) == "2015-03-01"
