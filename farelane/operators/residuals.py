"""Residual tables of scored trips (columns ``prediction`` and ``fare_amount``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.operators.profile import describe

FARE_BANDS = (0.0, 5.0, 10.0, 20.0, 40.0, 80.0)


def residuals(scored: DataFrame, prediction: str = "prediction", truth: str = "fare_amount") -> DataFrame:
    """Add ``residual``, prediction minus truth."""
    return scored.withColumn("residual", F.col(prediction) - F.col(truth))


def residual_summary(scored: DataFrame) -> DataFrame:
    return describe(residuals(scored), ["residual"])


def band_of(value: Column, edges: Sequence[float] = FARE_BANDS) -> Column:
    """Lower edge of the band a value falls in, ``[edge, next edge)``; null below the first edge."""
    band = F.lit(None).cast("double")
    for edge in edges:
        band = F.when(value >= F.lit(float(edge)), F.lit(float(edge))).otherwise(band)
    return band


def residual_bands(
    scored: DataFrame,
    edges: Sequence[float] = FARE_BANDS,
    prediction: str = "prediction",
    truth: str = "fare_amount",
) -> DataFrame:
    """Residuals by actual and by predicted fare band: ``(side, band, n, mean_residual, mae)``."""
    rows = residuals(scored, prediction, truth)
    by_side = rows.select(
        "residual",
        F.explode(
            F.array(
                F.struct(F.lit("actual").alias("side"), band_of(F.col(truth), edges).alias("band")),
                F.struct(F.lit("predicted").alias("side"), band_of(F.col(prediction), edges).alias("band")),
            )
        ).alias("at"),
    )
    return by_side.groupBy("at.side", "at.band").agg(
        F.count("*").alias("n"),
        F.avg("residual").alias("mean_residual"),
        F.avg(F.abs("residual")).alias("mae"),
    )


def sort_residuals(scored: DataFrame) -> DataFrame:
    """All rows, smallest residual first.

    Ties are broken by the row's hash, so a residual shared by many rows spreads
    over several range partitions.
    """
    rows = residuals(scored)
    return rows.orderBy("residual", F.xxhash64(*rows.columns))


def worst_k(scored: DataFrame, k: int, edges: Sequence[float] = FARE_BANDS, splits: int = 64) -> DataFrame:
    """The ``k`` largest absolute residuals per actual fare band, with their ``rank``.

    A band is split by a hash of the row; each part is ranked by itself, and then the
    ``k`` first of all parts, so that no task sorts a whole band whatever ``k`` is.
    """
    rows = residuals(scored).withColumn("band", band_of(F.col("fare_amount"), edges))
    ties = [c for c in rows.columns if c not in ("band", "residual")]
    worst = (F.desc(F.abs("residual")), *ties)
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(splits))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("band", part).orderBy(*worst))).filter(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("band").orderBy(*worst))).filter(F.col("rank") <= k)
