"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The JVM is warmed with one small run of every step on the smallest data set, then
each step is timed once, from the parquet scan to the last row or file.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("OMP_NUM_THREADS", "1")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from farelane.operators import chunks, clean, districts, features, profile  # noqa: E402
from farelane.plans import evaluate, score, train  # noqa: E402
from farelane.plans.dense import DenseSpec, fit_dense  # noqa: E402
from farelane.plans.preprocess import preprocess  # noqa: E402
from farelane.session import local_session  # noqa: E402
from farelane.sources.files import read_processed  # noqa: E402
from farelane.sources.trips import raw_trips, read_events, requests_from_events, stream_events, trips_from_events  # noqa: E402
from farelane.staging import new_folder  # noqa: E402
from farelane.streaming import trips as streams  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SMALL = "/root/testdata/sf0.001"


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def steps(spark, folder: str, rounds: int) -> dict:
    raw = raw_trips(spark, folder)
    tidy = clean.clean_trips(raw)
    processed = new_folder(spark, "bench")
    far = features.with_distance(tidy)

    def table():
        return read_processed(spark, processed)

    def fitted(kind, **options):
        rows = table()
        return evaluate.evaluate(train.predict(rows, train.fit(rows, kind, **options))).first().mae

    def stream():
        path = new_folder(spark, "bench-stream")
        streams.start(streams.stream_features(trips_from_events(stream_events(spark, folder))), path, f"{path}-state").awaitTermination()

    def line_evaluated():
        evaluate.evaluate(score.fit_distance_line(tidy)(tidy)).collect()

    return {
        "clean_trips": lambda: drain(tidy),
        "cleaning_report": lambda: clean.cleaning_report(raw).collect(),
        "weekday_fares": lambda: features.time_features(features.with_distances(tidy)).groupBy("dow").agg(F.avg("fare_amount"), F.avg("haversine_km"), F.count("*")).collect(),
        "clean_features_write": lambda: preprocess(raw, processed),
        "district_coverage": lambda: districts.coverage(tidy).collect(),
        "describe_trips": lambda: profile.describe(tidy, ["fare_amount", *clean.COORDINATES, "passenger_count"]).collect(),
        "correlation_matrix": lambda: profile.corr_long(table(), features.FEATURE_COLUMNS).collect(),
        "chunk_positions": lambda: drain(chunks.with_chunk_id(raw, ["pickup_datetime", "key"], 2000)),
        "cross_validation": lambda: evaluate.cv_linear_mae(far, "distance", "fare_amount", F.minute("pickup_datetime") % 5).collect(),
        "evaluate_line": line_evaluated,
        "scored_requests": lambda: drain(score.score_requests(requests_from_events(read_events(spark, folder)), score.line_scorer(2.5, 3.0))),
        "stream_features": stream,
        "linear_fit_score": lambda: fitted("linear"),
        "tree_fit_score": lambda: fitted("gbt", rounds=10, depth=4),
        "dense_rounds": lambda: fit_dense(table(), table(), spec=DenseSpec(learning_rate=0.005), epochs=rounds).history[-1]["val_mae"],
    }


def main() -> None:
    spark = local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8)
    for run in steps(spark, SMALL, 1).values():
        run()
    times, found = {}, {}
    for name, run in steps(spark, FOLDER, 3).items():
        started = time.perf_counter()
        found[name] = run()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "mae": {k: round(v, 4) for k, v in found.items() if isinstance(v, float)},
                "sf": os.path.basename(FOLDER.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
