"""Splitting, baselines and evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bucket(*key: Column | str, buckets: int = 100, seed: int = 42) -> Column:
    """A stable bucket 0..buckets-1 of a key, the same under any partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(buckets))


def split_by_key(df: DataFrame, bucket: Column, test_pct: int = 30) -> tuple[DataFrame, DataFrame]:
    """Train and test part. ``bucket`` is 0..99 per row, e.g. :func:`key_bucket`; rows
    below ``test_pct`` go to the test part."""
    return df.filter(bucket >= test_pct), df.filter(bucket < test_pct)


def evaluate(
    scored: DataFrame,
    by: Sequence[Column | str] = (),
    prediction: str = "prediction",
    truth: str = "fare_amount",
) -> DataFrame:
    """``(loss, mae, rows)``, loss being the mean squared error; per group with ``by``."""
    error = F.col(prediction) - F.col(truth)
    return scored.groupBy(*by).agg(
        F.avg(error * error).alias("loss"), F.avg(F.abs(error)).alias("mae"), F.count("*").alias("rows")
    )


def cv_linear_mae(df: DataFrame, x: str, y: str, fold: Column, folds: int = 5) -> DataFrame:
    """Cross-validated MAE of the line ``y ~ x``: ``(fold, slope, intercept, mae, rows)``.

    One aggregate yields the moments of each fold; the line of a training set is
    merged from the moments of the other folds. A second pass measures the errors.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), fold.alias("fold"))
    moments = (
        rows.groupBy("fold")
        .agg(
            F.count("*").alias("n"),
            F.avg("x").alias("mx"),
            F.avg("y").alias("my"),
            (F.var_pop("x") * F.count("*")).alias("sxx"),
            (F.covar_pop("x", "y") * F.count("*")).alias("sxy"),
        )
        .collect()
    )
    lines = []
    for k in range(folds):
        others = [m for m in moments if m.fold != k]
        n = sum(m.n for m in others)
        if n == 0:
            continue
        mx = sum(m.n * m.mx for m in others) / n
        my = sum(m.n * m.my for m in others) / n
        sxx = sum(m.sxx + m.n * (m.mx - mx) ** 2 for m in others)
        sxy = sum(m.sxy + m.n * (m.mx - mx) * (m.my - my) for m in others)
        slope = sxy / sxx if sxx else 0.0
        lines.append((k, slope, my - slope * mx))
    fits = df.sparkSession.createDataFrame(lines, "fold int, slope double, intercept double")
    # one line per fold
    tested = rows.withColumn("fold", F.col("fold").cast("int")).join(F.broadcast(fits), "fold")
    error = F.abs(F.col("intercept") + F.col("slope") * F.col("x") - F.col("y"))
    return tested.groupBy("fold", "slope", "intercept").agg(F.avg(error).alias("mae"), F.count("*").alias("rows"))
