import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from farelane.operators.clean import clean_trips, drop_duplicate_trips, filter_trips
from farelane.operators.features import with_target
from farelane.plans import registry
from farelane.plans.dense import DenseSpec
from farelane.plans.score import fit_distance_line
from farelane.schema import RAW
from farelane.sources.trips import raw_trips, stream_events, trips_from_events
from farelane.streaming import fit, trips as streams


def rows(df):
    return sorted(map(repr, df.collect()))


def land(spark, sdf, tmp_path, name="out"):
    path = str(tmp_path / name)
    streams.start(sdf, path, f"{path}-state").awaitTermination()
    return spark.read.schema(sdf.schema).parquet(path)


def test_stream_features_equal_batch(spark, folder, tmp_path):
    landed = land(spark, streams.stream_features(trips_from_events(stream_events(spark, folder))), tmp_path)
    assert rows(landed) == rows(with_target(filter_trips(raw_trips(spark, folder))))


def scattered(spark, raw, source, files):
    """The trips as a stream of files out of pickup order, one a batch; every trip of two passengers comes twice."""
    place = F.pmod(F.xxhash64("key", "fare_amount"), F.lit(files))
    for k in range(files):
        raw.filter(place == k).coalesce(1).write.mode("append").parquet(str(source))
    raw.filter("passenger_count = 2").coalesce(1).write.mode("append").parquet(str(source))
    return spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(str(source))


@pytest.mark.parametrize("files", [1, 4, 16])
def test_stream_dedup_equals_batch_on_any_layout(spark, folder, tmp_path, files):
    raw = raw_trips(spark, folder)
    odd = raw.limit(1).withColumns({"pickup_datetime": F.lit(None).cast("timestamp_ntz"), "fare_amount": F.lit(None).cast("double")})
    raw = raw.unionByName(odd).unionByName(odd)
    stream = scattered(spark, raw, tmp_path / "in", files)
    path = str(tmp_path / "out")
    for state in ("a", "a", "b"):  # "b" starts without its checkpoint and replays every batch
        streams.stream_dedup(stream, path, str(tmp_path / state), period="yyyy").awaitTermination()
    assert rows(streams.read_deduped(spark, path, RAW)) == rows(drop_duplicate_trips(raw.drop("key")))


@pytest.mark.parametrize("files", [1, 4, 16])
def test_stream_error_counts_every_trip_and_window(spark, folder, tmp_path, files):
    raw = raw_trips(spark, folder)
    line = fit_distance_line(clean_trips(raw))
    stream = scattered(spark, raw, tmp_path / "in", files)
    path = str(tmp_path / "out")
    for state in ("a", "b"):
        streams.stream_error(stream, line, path, str(tmp_path / state)).awaitTermination()
    scored = line(filter_trips(raw.unionByName(raw.filter("passenger_count = 2"))))
    whole = scored.groupBy(F.window(F.col("pickup_datetime").cast("timestamp"), "30 days").alias("w")).agg(
        F.avg(F.abs(F.col("prediction") - F.col("fare_amount"))).alias("mae"), F.count("*").alias("n")
    )
    want = {r.w.start: (r.mae, r.n) for r in whole.collect()}
    got = {r.window_start: (r.mae, r.rows) for r in streams.read_error(spark, path).collect()}
    assert want.keys() == got.keys()
    assert all(got[k][1] == n and abs(got[k][0] - mae) < 1e-9 for k, (mae, n) in want.items())


def test_stream_fit_survives_a_crash_between_model_and_log(spark, folder, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    feed = streams.stream_features(trips_from_events(stream_events(spark, folder)))
    valid = with_target(clean_trips(raw_trips(spark, folder)))
    spec = DenseSpec(learning_rate=0.01)
    whole = registry.log_run

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(registry, "log_run", crash)
    with pytest.raises(StreamingQueryException):
        fit.stream_fit(feed, valid, root, str(tmp_path / "a"), spec=spec, epochs=1).awaitTermination()
    assert registry.read_runs(spark, root).count() == 0
    weights = registry.load_latest(spark, root, "stream").weights
    monkeypatch.setattr(registry, "log_run", whole)
    for state in ("a", "a", "b"):  # "b" starts without its checkpoint and replays batch 0
        fit.stream_fit(feed, valid, root, str(tmp_path / state), spec=spec, epochs=1).awaitTermination()
    assert registry.read_runs(spark, root).count() == 1
    assert registry.read_models(spark, root).count() == 1
    assert (registry.load_latest(spark, root, "stream").weights == weights).all()


def test_periodic_refresh_picks_up_new_files(spark, folder, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    raw = raw_trips(spark, folder)
    raw.write.parquet(str(source))
    stream = filter_trips(spark.readStream.schema(RAW).parquet(str(source)))
    query = streams.start(stream, path, f"{path}-state", every="1 second")
    try:
        query.processAllAvailable()
        once = spark.read.parquet(path).count()
        raw.write.mode("append").parquet(str(source))
        query.processAllAvailable()
    finally:
        query.stop()
    assert once == filter_trips(raw).count()
    assert spark.read.parquet(path).count() == 2 * once
