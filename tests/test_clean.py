import math

import pytest

from farelane.operators import clean
from farelane.operators.clean import clean_trips, cleaning_report
from farelane.schema import COORDINATES, Limits
from farelane.sources.trips import raw_trips


def kept(df):
    return clean_trips(df).count() == 1


EPS = 1e-9
EDGES = [("latitude", 40.5, 40.9), ("longitude", -74.3, -73.7)]


@pytest.mark.parametrize("end", ["pickup", "dropoff"])
@pytest.mark.parametrize(("axis", "lo", "hi"), EDGES)
def test_box_edges_belong_to_the_box(trips, end, axis, lo, hi):
    name = f"{end}_{axis}"
    for value, inside in [(lo, True), (lo + EPS, True), (lo - EPS, False), (hi, True), (hi - EPS, True), (hi + EPS, False)]:
        assert kept(trips({name: value})) is inside, (name, value)


@pytest.mark.parametrize(("fare", "inside"), [(0.0, False), (-1.0, False), (0.01, True), (399.99, True), (400.0, False)])
def test_fare_bounds_are_strict(trips, fare, inside):
    assert kept(trips({"fare_amount": fare})) is inside


@pytest.mark.parametrize(("count", "inside"), [(0, False), (1, True), (7, True), (8, False)])
def test_passenger_bounds_are_strict(trips, count, inside):
    assert kept(trips({"passenger_count": count})) is inside


@pytest.mark.parametrize("name", ["fare_amount", "pickup_datetime", *COORDINATES, "passenger_count"])
def test_missing_values_go(trips, name):
    assert not kept(trips({name: None}))
    if name not in ("pickup_datetime", "passenger_count"):
        assert not kept(trips({name: math.nan}))


@pytest.mark.parametrize("zeros", [1, 2, 3, 4])
def test_only_all_zero_coordinates_go(trips, zeros):
    df = trips({c: 0.0 for c in COORDINATES[:zeros]})
    assert clean.drop_zero_coordinates(df).count() == (0 if zeros == 4 else 1)


def test_key_is_not_part_of_the_trip(trips):
    df = trips({"key": "a"}, {"key": "b"}, {"key": "c", "fare_amount": 12.0})
    assert clean_trips(df).count() == 2
    assert "key" not in clean_trips(df).columns


def test_missing_key_does_not_matter(trips):
    assert kept(trips({"key": None}))


def test_duplicates_far_apart_are_removed(spark, trips):
    """The result must not depend on how the rows are cut up."""
    df = trips(*({"key": str(i), "fare_amount": float(1 + i % 10)} for i in range(200)))
    for parts in (1, 4, 32):
        assert clean_trips(df.repartition(parts)).count() == 10


def test_empty_part_does_not_end_the_run(spark, trips):
    bad, good = trips(*({"fare_amount": -1.0} for _ in range(5))), trips({})
    assert clean_trips(bad.union(good)).count() == 1


def test_partitioning_does_not_change_the_result(spark, folder):
    raw = raw_trips(spark, folder)
    results = [sorted(map(tuple, clean_trips(raw.repartition(n)).collect())) for n in (1, 4, 32)]
    assert results[0] == results[1] == results[2]


def test_report_adds_up(spark, folder):
    raw = raw_trips(spark, folder)
    report = {r.rule: r for r in cleaning_report(raw).collect()}
    assert report["raw"].remaining == raw.count()
    assert report["longitude_box"].remaining == clean_trips(raw).count()
    assert report["fare_high"].rejected == raw.filter("not coalesce(fare_amount < 400, false)").count()


def test_custom_limits(trips):
    assert clean_trips(trips({"fare_amount": 500.0}), Limits(fare_below=1000.0)).count() == 1


def test_filters_reach_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "trips")
    raw_trips(spark, folder).write.parquet(path)
    plan = clean_trips(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "key" not in scan.split("ReadSchema")[1]
    assert "GreaterThanOrEqual" in scan or "PushedFilters: [" in scan
    assert plan.count("Exchange") == 1
