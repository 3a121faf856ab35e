"""Streams with Spark's own state: duplicates within a delay, and windows of event time that close.

Spark drops a row that comes behind the watermark without a word. Here a gate stands
before the stateful query: it keeps the highest event time of the batches so far, sends
rows behind it to a late path, and hands the others over batch by batch, so the state
never meets a late row and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farelane.functions import to_instant
from farelane.operators.clean import filter_trips
from farelane.plans.score import Scorer
from farelane.staging import is_complete
from farelane.streaming.trips import BATCH, PERIOD, put_new, read_landed, run_batches

#: Event time as a ``timestamp``.
AT = "_event_time"
_MARKS = T.StructType([T.StructField("high", T.TimestampType())])


def _mark(spark: SparkSession, path: str, batch_id: int, delay: str):
    """The watermark before a batch: the highest event time of earlier batches less ``delay``; None before the first."""
    marks = read_landed(spark, f"{path}/marks", _MARKS).filter(F.col(BATCH) < batch_id)
    return marks.agg((F.max("high") - F.expr(f"INTERVAL {delay}")).alias("m")).first()["m"]


def gated(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    delay: str,
    is_late: Callable[[Column], Column],
    late: Callable[[DataFrame, int], None],
    state: Callable[[DataFrame], DataFrame],
    every: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Send the rows of a stream with :data:`AT` that ``is_late`` accepts, given the watermark, to ``late``; all others through ``state``.

    ``state`` maps the stream of rows in time, with its watermark set, to the rows that are
    appended below ``{path}/closed``. Each batch of the gate is written once and becomes one batch of
    the stateful query, which runs after it over what is there; its watermark is thus never
    ahead of the gate's. A batch that is replayed finds its rows written and hands over nothing twice; its late rows and
    its mark replace themselves.
    """
    spark, schema = rows.sparkSession, rows.schema

    def advance() -> None:
        arrived = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("cleanSource", "delete").parquet(f"{path}/in_time")
        out = state(arrived.withWatermark(AT, delay)).writeStream.outputMode("append").format("parquet")
        out = out.partitionBy(*partition_by) if partition_by else out
        out = out.option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True)
        out.start(f"{path}/closed").awaitTermination()

    def put(batch: DataFrame, batch_id: int) -> None:
        mark = _mark(batch.sparkSession, path, batch_id, delay)
        behind = F.col(AT).isNull() | (F.lit(False) if mark is None else is_late(F.lit(mark)))
        batch = batch.withColumn("_behind", F.coalesce(behind, F.lit(False))).persist()
        try:
            target = f"{path}/in_time/{batch_id:012d}"
            if not is_complete(spark, target):
                batch.filter("NOT _behind").drop("_behind").write.mode("overwrite").parquet(target)
            late(batch.filter("_behind").drop("_behind"), batch_id)
            batch.agg(F.max(AT).alias("high")).write.mode("overwrite").parquet(f"{path}/marks/{BATCH}={batch_id}")
        finally:
            batch.unpersist()
        advance()

    return run_batches(rows, put, f"{checkpoint}/gate", every)


def dedup_within(sdf: DataFrame, path: str, checkpoint: str, delay: str = "2 days", every: str | None = None, period: str = "yyyyMM") -> StreamingQuery:
    """Land trips without their key, each distinct trip once, with state for ``delay`` of pickup time only.

    Copies that come while the watermark (the latest pickup less ``delay``) is not past their pickup meet the first one in
    Spark's state store, and no landed trip is read. A trip behind the watermark, or without a
    pickup time, goes to the late path, where it is compared with the late trips of its months.
    :func:`read_within` gives every distinct trip once.
    """
    columns = [c for c in sdf.columns if c != "key"]
    when = F.coalesce(F.date_format("pickup_datetime", period).cast("int"), F.lit(0))
    rows = sdf.select(*columns, when.alias(PERIOD), to_instant(F.col("pickup_datetime")).alias(AT))
    kept = T.StructType([f for f in sdf.schema.fields if f.name != "key"])

    def late(batch: DataFrame, batch_id: int) -> None:
        put_new(batch.drop(AT), batch_id, f"{path}/late", kept)

    def state(arrived: DataFrame) -> DataFrame:
        return arrived.dropDuplicatesWithinWatermark([*columns]).drop(AT)

    return gated(rows, path, checkpoint, delay, lambda mark: F.col(AT) <= mark, late, state, every, (PERIOD,))


def read_within(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The trips that :func:`dedup_within` has landed: those in time, and late ones that no trip in time equals.

    Only the months that late trips have are compared.
    """
    kept = [f.name for f in schema.fields if f.name != "key"]
    dated = T.StructType([*(f for f in schema.fields if f.name != "key"), T.StructField(PERIOD, T.IntegerType())])
    closed = spark.read.schema(dated).parquet(f"{path}/closed")
    behind = read_landed(spark, f"{path}/late", dated)
    periods = [r[0] for r in behind.select(PERIOD).distinct().collect()]  # one number per calendar month or year
    met = closed.filter(F.col(PERIOD).isin(periods)).select(*kept)
    return closed.select(*kept).unionByName(behind.select(*kept).exceptAll(met).distinct())


def error_windows(
    sdf: DataFrame, scorer: Scorer, path: str, checkpoint: str, window: str = "30 days", delay: str = "2 days", every: str | None = None
) -> StreamingQuery:
    """Sums of absolute errors per tumbling window of pickup time, appended when the watermark passes a window's end.

    Open windows are Spark's state. A trip whose window has closed is a correction: each batch
    lands one row per such window. :func:`read_windows` merges closed windows, corrections and, on
    request, the windows still open.
    """
    scored = scorer(filter_trips(sdf))
    error = F.abs(F.col("prediction") - F.col("fare_amount"))
    rows = scored.select(to_instant(F.col("pickup_datetime")).alias(AT), error.alias("error"))

    def summed(df: DataFrame) -> DataFrame:
        parts = df.groupBy(F.window(AT, window).alias("w")).agg(F.sum("error").alias("error"), F.count("*").alias("rows"))
        return parts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "error", "rows")

    def late(batch: DataFrame, batch_id: int) -> None:
        summed(batch).write.mode("overwrite").parquet(f"{path}/corrections/{BATCH}={batch_id}")

    return gated(rows, path, checkpoint, delay, lambda mark: F.window(F.col(AT), window)["end"] <= mark, late, summed, every)


def read_windows(spark: SparkSession, path: str, checkpoint: str, flush: bool = True) -> DataFrame:
    """``(window_start, window_end, mae, rows, corrections)``: closed windows with their late trips.

    ``flush`` adds the windows that are still open, read from the state of the last
    batch; the stream can go on after it.
    """
    schema = T.StructType.fromDDL("window_start timestamp, window_end timestamp, error double, rows long")
    corrections = read_landed(spark, f"{path}/corrections", schema)
    parts = spark.read.schema(schema).parquet(f"{path}/closed").withColumn("late", F.lit(0).cast("long"))
    parts = parts.unionByName(corrections.select(*schema.names, F.col("rows").alias("late")))
    if flush:
        held = spark.read.format("statestore").load(f"{checkpoint}/state")
        held = held.selectExpr("key.window.start AS window_start", "key.window.end AS window_end", "value.sum AS error", "value.count AS rows", "0L AS late")
        parts = parts.unionByName(held)
    merged = parts.groupBy("window_start", "window_end").agg(F.sum("error").alias("error"), F.sum("rows").alias("rows"), F.sum("late").alias("corrections"))
    return merged.select("window_start", "window_end", (F.col("error") / F.col("rows")).alias("mae"), "rows", "corrections")
