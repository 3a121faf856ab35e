"""Equal-width histograms and density grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.operators.clean import in_bbox
from farelane.staging import staged


def bin_index(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Index of the equal-width bin; the last bin includes ``hi``."""
    width = (hi - lo) / bins
    return F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")


def _bounds(df: DataFrame, cols: list[str]) -> tuple[float, float] | None:
    low = F.least(*(F.min(c) for c in cols)) if len(cols) > 1 else F.min(cols[0])
    high = F.greatest(*(F.max(c) for c in cols)) if len(cols) > 1 else F.max(cols[0])
    lo, hi = df.agg(low.cast("double"), high.cast("double")).first()
    if lo is None:
        return None
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)


def _spread(counts: DataFrame, keys: list[Column], bins: int, lo: float, hi: float, outside: bool = False) -> DataFrame:
    """Add the empty bins: ``keys`` x bins rows, both known beforehand."""
    width = (hi - lo) / bins
    spark = counts.sparkSession
    first, last = (-1, bins + 1) if outside else (0, bins)
    frame = spark.range(first, last).select(F.col("id").cast("int").alias("bin"), *keys)
    names = [c for c in frame.columns]
    return frame.join(counts, names, "left").select(
        *[n for n in names if n != "bin"],
        "bin",
        F.when(F.col("bin") >= 0, F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        F.when(F.col("bin") < bins, F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def _counted(rows: DataFrame, keys: list[str], bins: int, lo: float, hi: float, outside: bool) -> DataFrame:
    """``(keys, bin, n)`` of column ``x``; values outside go to bin -1 or ``bins`` if asked for."""
    x = F.col("x")
    place = F.when(x < lo, -1).when(x > hi, bins).otherwise(bin_index(x, lo, hi, bins))
    kept = rows.filter(x.isNotNull() & ~F.isnan(x) if outside else x.between(lo, hi))
    return kept.groupBy(*keys, place.alias("bin")).agg(F.count("*").alias("n"))


def histogram(
    df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None, outside: bool = False
) -> DataFrame:
    """``(bin, bin_lo, bin_hi, n)`` with empty bins.

    Without ``lo`` and ``hi`` the range is that of the data: the column is written once,
    and bounds and counts read the copy. ``outside`` adds bin -1 for values below ``lo``
    and bin ``bins`` for those above ``hi``, open on their outer side.
    """
    values = df.select(F.col(col).cast("double").alias("x"))
    if lo is not None and hi is not None:
        return _spread(_counted(values, [], bins, lo, hi, outside), [], bins, lo, hi, outside)
    with staged(values, "histogram") as copy:
        lo, hi = _bounds(copy, ["x"]) or (0.0, 1.0)
        counts = _counted(copy, [], bins, lo, hi, outside).collect()  # one row per bin
    held = df.sparkSession.createDataFrame(counts, "bin int, n long")
    return _spread(held, [], bins, lo, hi, outside)


def pred_truth_hist(
    scored: DataFrame, bins: int, prediction: str = "prediction", truth: str = "fare_amount"
) -> DataFrame:
    """Histograms of prediction and truth on common edges, as ``(series, bin, bin_lo, bin_hi, n)``."""
    both = scored.select(
        F.inline(
            F.array(
                F.struct(F.lit("prediction").alias("series"), F.col(prediction).cast("double").alias("x")),
                F.struct(F.lit("truth").alias("series"), F.col(truth).cast("double").alias("x")),
            )
        )
    )
    with staged(both, "histogram") as copy:
        lo, hi = _bounds(copy, ["x"]) or (0.0, 1.0)
        counts = _counted(copy, ["series"], bins, lo, hi, False).collect()  # two rows per bin
    held = scored.sparkSession.createDataFrame(counts, "series string, bin int, n long")
    series = F.explode(F.array(F.lit("prediction"), F.lit("truth"))).alias("series")
    return _spread(held, [series], bins, lo, hi)


def density_grid(
    df: DataFrame, lon_min: float, lon_max: float, lat_min: float, lat_max: float, nx: int, ny: int
) -> DataFrame:
    """Trip ends per grid cell, for trips with both ends in the box: ``(trip_end, ix, iy, n)``."""
    ends = in_bbox(df, lon_min, lon_max, lat_min, lat_max).select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(end).alias("trip_end"),
                        F.col(f"{end}_longitude").alias("lon"),
                        F.col(f"{end}_latitude").alias("lat"),
                    )
                    for end in ("pickup", "dropoff")
                )
            )
        )
    )
    return ends.groupBy(
        "trip_end",
        bin_index(F.col("lon"), lon_min, lon_max, nx).alias("ix"),
        bin_index(F.col("lat"), lat_min, lat_max, ny).alias("iy"),
    ).agg(F.count("*").alias("n"))
