"""Bulk scoring of trips and of user requests."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.functions import format_utc, local_status, local_to_utc
from farelane.operators.features import to_vector, trip_features, with_distance
from farelane.operators.profile import fit_line
from farelane.plans.dense import DenseModel

Scorer = Callable[[DataFrame], DataFrame]


def line_scorer(slope: float, intercept: float) -> Scorer:
    """Predict from the manhattan distance alone."""

    def score_line(trips: DataFrame) -> DataFrame:
        return with_distance(trips).withColumn("prediction", F.lit(intercept) + F.lit(slope) * F.col("distance"))

    return score_line


def fit_distance_line(trips: DataFrame) -> Scorer:
    """The baseline: fare on distance, one aggregate."""
    line = fit_line(with_distance(trips), "distance", "fare_amount").first()
    return line_scorer(line.slope, line.intercept)


def ml_scorer(model, keep: tuple[str, ...] = ()) -> Scorer:
    """Score raw trips with a linear, tree or network model over the 65 features."""

    def score_ml(trips: DataFrame) -> DataFrame:
        names = keep or tuple(trips.columns)
        made = trip_features(trips, keep=names)
        scored = model.transform(made) if isinstance(model, DenseModel) else model.transform(to_vector(made))
        return scored.select(*names, "prediction")

    return score_ml


def score(trips: DataFrame, scorer: Scorer) -> DataFrame:
    """Trips with their ``prediction``; no cleaning is applied."""
    return scorer(trips)


def complete() -> Column:
    """Whether a request has all its fields: none of them null or NaN."""
    numbers = [F.col(c) for c in ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "passenger_count")]
    return reduce(Column.__and__, (c.isNotNull() & ~F.isnan(c.cast("double")) for c in numbers), F.col("pickup_datetime").isNotNull())


def with_utc(requests: DataFrame) -> DataFrame:
    """Add ``status``, the UTC time ``utc`` and its text ``utc_text`` to requests in New
    York wall time. A request with a missing field has the status ``missing``; a time
    that does not exist or happens twice has a status, too. None of them has a UTC."""
    local = F.col("pickup_datetime")
    checked = requests.withColumn("status", F.when(complete(), local_status(local)).otherwise("missing"))
    safe = checked.withColumn("utc", F.when(F.col("status") == "ok", local_to_utc(local)))
    return safe.withColumn("utc_text", format_utc(F.col("utc")))


def score_requests(requests: DataFrame, scorer: Scorer) -> DataFrame:
    """``(request_id, status, fare)``, one row per request; no fare unless the status is ok."""
    timed = with_utc(requests)
    trips = timed.withColumn("pickup_datetime", F.col("utc"))
    scored = scorer(trips)
    return scored.select(
        "request_id", "status", F.when(F.col("status") == "ok", F.col("prediction")).alias("fare")
    )
