"""Cleaning, features, duplicate removal and error monitoring on streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farelane.functions import to_instant
from farelane.operators.clean import filter_trips
from farelane.operators.features import trip_features
from farelane.plans.score import Scorer
from farelane.schema import DEFAULT_LIMITS, Limits

#: Folder columns of landed tables.
BATCH, PERIOD = "batch_id", "pickup_period"


def stream_features(sdf: DataFrame, limits: Limits = DEFAULT_LIMITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Row filters and the 66 columns: stateless, the same code as in batch."""
    return trip_features(filter_trips(sdf, limits), keep=keep, target=True)


def _landed(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """What earlier batches have put below ``path``."""
    return read_landed(spark, path, schema).filter(F.col(BATCH) < batch_id)


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows below ``path`` with the batch that put them there; nothing yet gives no rows."""
    declared = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(declared).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], declared)


def run_batches(sdf: DataFrame, put: Callable[[DataFrame, int], None], checkpoint: str, every: str | None) -> StreamingQuery:
    writer = sdf.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start()


def stream_dedup(
    sdf: DataFrame, path: str, checkpoint: str, every: str | None = None, period: str = "yyyyMM"
) -> StreamingQuery:
    """Land trips without their key, each distinct trip once, however late its copies arrive.

    A batch is compared with the trips that earlier batches have landed in the same
    pickup months (or years, by ``period``), which the folders of the landed table prune
    to; copies are combined before the shuffle, and nulls equal nulls. A batch owns its folder and replaces it
    whole, so a replay lands nothing twice. Read the result with :func:`read_deduped`.
    """
    columns = [c for c in sdf.columns if c != "key"]
    schema = T.StructType([f for f in sdf.schema.fields if f.name != "key"])
    when = F.coalesce(F.date_format("pickup_datetime", period).cast("int"), F.lit(0))

    def put(batch: DataFrame, batch_id: int) -> None:
        put_new(batch.select(*columns, when.alias(PERIOD)), batch_id, path, schema)

    return run_batches(sdf, put, checkpoint, every)


def put_new(batch: DataFrame, batch_id: int, path: str, schema: T.StructType) -> None:
    """Land the distinct rows of a batch (``schema`` and :data:`PERIOD`) that earlier batches have not landed below ``path``."""
    spark = batch.sparkSession
    columns = schema.names
    fresh = batch.distinct().persist()
    try:
        periods = [r[0] for r in fresh.select(PERIOD).distinct().collect()]  # one number per calendar month or year
        dated = T.StructType([*schema.fields, T.StructField(PERIOD, T.IntegerType())])
        old = _landed(spark, path, dated, batch_id).filter(F.col(PERIOD).isin(periods)).select(*columns, PERIOD, F.lit(True).alias("old"))
        both = fresh.withColumn("old", F.lit(False)).unionByName(old)
        new = both.groupBy(*columns, PERIOD).agg(F.max("old").alias("old")).filter("NOT old").drop("old")
        out = new.hint("rebalance", PERIOD).write.mode("overwrite").partitionBy(PERIOD)
        out.parquet(f"{path}/{BATCH}={batch_id}")
    finally:
        fresh.unpersist()


def read_deduped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The trips that :func:`stream_dedup` has landed; ``schema`` is that of its input."""
    kept = [f for f in schema.fields if f.name != "key"]
    return read_landed(spark, path, T.StructType(kept)).select(*(f.name for f in kept))


def stream_error(sdf: DataFrame, scorer: Scorer, path: str, checkpoint: str, window: str = "30 days", every: str | None = None) -> StreamingQuery:
    """Land, for each batch and tumbling window of pickup time, the sum of absolute errors and their number.

    There is no watermark: trips come in any order, and a late one adds to its window.
    A batch owns its folder and replaces it whole. :func:`read_error` merges the parts.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        scored = scorer(filter_trips(batch))
        error = F.abs(F.col("prediction") - F.col("fare_amount"))
        parts = (
            scored.groupBy(F.window(to_instant(F.col("pickup_datetime")), window).alias("w"))
            .agg(F.sum(error).alias("error"), F.count("*").alias("rows"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "error", "rows")
        )
        parts.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return run_batches(sdf, put, checkpoint, every)


def read_error(spark: SparkSession, path: str) -> DataFrame:
    """``(window_start, window_end, mae, rows)`` over all batches so far, the last windows included."""
    parts = read_landed(spark, path, T.StructType.fromDDL("window_start timestamp, window_end timestamp, error double, rows long"))
    summed = parts.groupBy("window_start", "window_end").agg(F.sum("error").alias("error"), F.sum("rows").alias("rows"))
    return summed.select("window_start", "window_end", (F.col("error") / F.col("rows")).alias("mae"), "rows")


def _trigger(every: str | None) -> dict:
    return {"availableNow": True} if every is None else {"processingTime": every}


def start(sdf: DataFrame, path: str, checkpoint: str, every: str | None = None, fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to files: every ``every`` (e.g. ``2 minutes``), or with None once
    over everything that is there. Exactly once, through the checkpoint folder."""
    writer = sdf.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start(path)
