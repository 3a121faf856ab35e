"""Raw table to processed table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from farelane.operators.clean import clean_trips
from farelane.operators.features import trip_features
from farelane.schema import DEFAULT_LIMITS, Limits
from farelane.sources.files import read_processed, write_dataset


@dataclass(frozen=True)
class Processed:
    """What a preprocessing run saw."""

    rows: int
    cleaned_rows: int


def preprocess(
    source: DataFrame,
    dest: str,
    limits: Limits = DEFAULT_LIMITS,
    by_month: bool = False,
    fmt: str = "parquet",
    table: bool = False,
    text: bool = False,
) -> Processed:
    """Clean ``source``, build the 66 columns and write them: one job, one shuffle.

    The output is counted by a column-free scan, and so is the source: on parquet those
    read footers only, while an observation inside the job would keep the filters from
    reaching the scan. A ``text`` source has no filters to push and would be parsed
    twice; it is counted inside the job. ``by_month`` partitions the output
    by the ``year`` and ``month`` of the pickup, so later readers can prune.
    """
    seen = Observation()
    clean = clean_trips(source.observe(seen, F.count(F.lit(1)).alias("rows")) if text else source, limits)
    if by_month:
        dated = clean.withColumns({"year": F.year("pickup_datetime"), "month": F.month("pickup_datetime")})
        out = trip_features(dated, keep=("year", "month"), target=True)
        write_dataset(out, dest, "overwrite", fmt, table, ("year", "month"))
    else:
        write_dataset(trip_features(clean, target=True), dest, "overwrite", fmt, table)
    spark = source.sparkSession
    written = spark.table(dest) if table else read_processed(spark, dest, fmt)
    return Processed(seen.get["rows"] if text else source.count(), written.count())
