"""Summaries kept per pickup month that merge without reading trips again: sketches and Gram matrices.

A month's row is computed from that month's trips alone and replaces itself, so a new
month costs one read of that month, and any span of months is a merge of small rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.functions import cell_id

#: Registers of the distinct-count sketches, as a power of two: a standard error of 0.4 %.
REGISTERS = 16
#: Size of the quantile sketches: a rank error of about 0.3 %.
LEVEL = 800
_SALTS = 16


def month(df: DataFrame) -> Column:
    """``yyyymm`` of the pickup; 0 without one."""
    return F.coalesce(F.date_format("pickup_datetime", "yyyyMM").cast("int"), F.lit(0))


def monthly_sketches(df: DataFrame, value: str = "fare_amount", precision: int = 5) -> DataFrame:
    """``(pickup_month, rows, districts, trips, quantiles)``: sketches of the districts that trips start or end in, of different trips (without the key) and of ``value``."""
    ends = [cell_id(F.col(f"{e}_latitude"), F.col(f"{e}_longitude"), precision) for e in ("pickup", "dropoff")]
    trip = F.xxhash64(*(c for c in df.columns if c != "key"))
    both = df.select(month(df).alias("pickup_month"), trip.alias("trip"), F.col(value).cast("double").alias("value"), F.array(*ends).alias("ends"))
    sketch = lambda c: F.hll_sketch_agg(c, F.lit(REGISTERS))
    # two sketches, one for each end, in the same pass
    made = both.groupBy("pickup_month").agg(
        F.count("*").alias("rows"), sketch(F.col("ends")[0]).alias("a"), sketch(F.col("ends")[1]).alias("b"), sketch(F.col("trip")).alias("trips"),
        F.kll_sketch_agg_double("value", F.lit(LEVEL)).alias("quantiles"),
    )
    return made.select("pickup_month", "rows", F.hll_union("a", "b").alias("districts"), "trips", "quantiles")


def put_months(summaries: DataFrame, path: str) -> None:
    """Write the months' rows below ``path``; months that are there already are replaced, others stay."""
    summaries.write.partitionBy("pickup_month").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def merged_counts(table: DataFrame) -> DataFrame:
    """``(rows, districts, trips)`` over all months of the table; the last two are estimates."""
    return table.agg(
        F.sum("rows").alias("rows"), F.hll_sketch_estimate(F.hll_union_agg("districts")).alias("districts"), F.hll_sketch_estimate(F.hll_union_agg("trips")).alias("trips")
    )


def merged_quantiles(table: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``(prob, value)`` over all months of the table."""
    merged = table.agg(F.kll_merge_agg_double("quantiles").alias("q"))
    found = F.array(*(F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("q", F.lit(float(p))).alias("value")) for p in probs))
    return merged.select(F.inline(found))


# ---------------------------------------------------------------- Gram matrices


def _partial(width: int):
    """For each month that a task reads: the sum of outer products of (1, columns)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in source:
            months = batch.column(0).to_numpy()
            x = np.ones((batch.num_rows, width))
            for k, c in enumerate(batch.columns[1:]):
                x[:, k + 1] = c.to_numpy(zero_copy_only=False)
            for m in np.unique(months).tolist():
                rows = x[months == m]
                held[m] = held.get(m, 0.0) + rows.T @ rows
        if held:
            grams = pa.array([g.ravel() for g in held.values()], pa.list_(pa.float64()))
            yield pa.record_batch([pa.array(list(held), pa.int32()), grams], names=["pickup_month", "gram"])

    return run


def _added(key: tuple, table: pa.Table) -> pa.Table:
    total = sum(g.values.to_numpy() for g in table.column("gram"))
    return pa.table({"pickup_month": pa.array([key[0].as_py()], pa.int32()), "gram": pa.array([total], pa.list_(pa.float64()))})


def monthly_grams(df: DataFrame, columns: Sequence[str], when: Column) -> DataFrame:
    """``(pickup_month, gram)``: per month the Gram matrix of a one and the columns, row after row.

    Rows with a missing value are left out. Tasks add their rows up, so the shuffle carries
    one matrix per task and month.
    """
    whole = df.select(when.cast("int").alias("pickup_month"), *(F.col(c).cast("double").alias(c) for c in columns)).dropna(subset=list(columns))
    parts = whole.mapInArrow(_partial(len(columns) + 1), "pickup_month int, gram array<double>")
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    some = salted.groupBy("pickup_month", "salt").applyInArrow(_added, "pickup_month int, gram array<double>")
    return some.groupBy("pickup_month").applyInArrow(_added, "pickup_month int, gram array<double>")


def total_gram(table: DataFrame) -> np.ndarray:
    """The sum over all months: one square matrix, whose size depends on the columns only."""
    found = table.select(F.lit(0).alias("pickup_month"), "gram").groupBy("pickup_month").applyInArrow(_added, "pickup_month int, gram array<double>").first()
    if found is None:
        raise ValueError("no months")
    flat = np.array(found["gram"])
    return flat.reshape(int(len(flat) ** 0.5), -1)


def covariance(gram: np.ndarray) -> np.ndarray:
    n, mean = gram[0, 0], gram[0, 1:] / gram[0, 0]
    return gram[1:, 1:] / n - np.outer(mean, mean)


def correlations(spark: SparkSession, gram: np.ndarray, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix as ``(i, j, r)``; pairs with a constant column have a null ``r``."""
    cov = covariance(gram)
    scale = np.abs(np.diag(gram)[1:]) / gram[0, 0]
    spread = [bool(v > 1e-13 * s) for v, s in zip(np.diag(cov), scale)]
    out = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            r = float(cov[i, j] / np.sqrt(cov[i, i] * cov[j, j])) if spread[i] and spread[j] else None
            out.append((a, b, r if r is None else max(-1.0, min(1.0, r))))
    return spark.createDataFrame(out, "i string, j string, r double")


def least_squares(gram: np.ndarray) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) of the last column on the others, of least norm where they are not unique."""
    cov, mean = covariance(gram), gram[0, 1:] / gram[0, 0]
    weights = np.linalg.lstsq(cov[:-1, :-1], cov[:-1, -1], rcond=1e-10)[0]
    return float(mean[-1] - mean[:-1] @ weights), weights
