"""What the text operators share: the shared folder, checkpoints, packed arrays, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.staging import shared_dir

#: Bytes of text that a task works on at once; bounds the arrays a batch needs.
CHUNK = 1 << 20


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no rerun."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)


def folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; set below the warehouse only where none is named."""
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return current or shared_dir(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(col: str) -> Column:
    """A text column as bytes, so that tasks neither decode nor encode it."""
    return F.col(col).cast("string").cast("binary")


def batches(fn: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch | None]) -> Callable:
    """``fn`` over slices of about :data:`CHUNK` bytes, for ``mapInArrow``."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for piece in slices(batch):
                out = fn(piece)
                if out is not None:
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return run


def slices(batch: pa.RecordBatch, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about ``limit`` bytes; a longer row stands alone."""
    n = batch.num_rows
    if not n:
        return
    rows = max(1, int(n * limit / max(batch.nbytes, 1)))
    if rows >= n:
        yield batch
        return
    size = np.zeros(n, np.int64)
    for column in batch.columns:
        if pa.types.is_binary(column.type) or pa.types.is_string(column.type):
            size += np.asarray(pc.binary_length(column).fill_null(0))
    total = np.cumsum(size + 16)
    start = 0
    while start < n:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str, values: dict[str, str]) -> DataFrame:
    """``rows`` with the ``values`` (name in ``classes`` -> new name) of each row's class, null where it has none.

    ``classes`` has one row per ``key`` and in ``size`` how many rows have it. A class of more than a fair share of
    the rows is met in a broadcast, and there are at most four times as many of these as partitions;
    its rows are dealt evenly, so no task holds a whole large class. ``rows`` must come in a fixed
    order from a scan or a checkpoint, so that a lost task deals them alike.
    """
    classes, many = cut(classes), 4 * partitions(rows.sparkSession)
    share = (classes.agg(F.sum(size)).first()[0] or 0) / many
    held = F.struct(*(F.col(a).alias(b) for a, b in values.items()))
    large = classes.filter(F.col(size) > share).select(F.col(key).alias("__large_key"), held.alias("__large"))
    none = F.pmod(F.col(size), F.lit(1)).cast("int")  # 0, but no literal: a literal would be no key of the join
    small = classes.filter(F.col(size) <= share).select(F.col(key).alias("__small_key"), none.alias("__none"), held.alias("__small"))
    met = rows.join(F.broadcast(large), F.col(key) == F.col("__large_key"), "left")
    deal = F.when(F.col("__large").isNull(), 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(64 * many)).cast("int"))
    met = met.withColumn("__deal", deal)
    met = met.join(small, (F.col(key) == F.col("__small_key")) & (F.col("__deal") == F.col("__none")), "left")
    found = [F.coalesce(F.col(f"__large.{b}"), F.col(f"__small.{b}")).alias(b) for b in values.values()]
    return met.select(*rows.columns, *found)
