"""The monthly feed: ``{split}_{month}`` replaces ``{split}_new``, as plain folders or in one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farelane.schema import FEED_MONTHS
from farelane.sources.catalog import SPLITS
from farelane.sources.files import read_raw, write_dataset
from farelane.sources.versions import commit, read_version


def ingest_month(spark: SparkSession, root: str, month: str, fmt: str = "csv") -> DataFrame:
    """Replace ``{root}/train_new`` and ``{root}/val_new`` with the month's files.

    Returns ``(split, month, rows)``; rows are counted while they are written.
    """
    if month not in FEED_MONTHS:
        raise ValueError(f"{month!r} is not a feed month, use one of {', '.join(FEED_MONTHS)}")
    loaded = []
    for split in SPLITS:
        seen = Observation()
        source = read_raw(spark, f"{root.rstrip('/')}/{split}_{month}", fmt)
        write_dataset(source.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root.rstrip('/')}/{split}_new")
        loaded.append((split, month, seen.get["rows"]))
    return spark.createDataFrame(loaded, "split string, month string, rows long")


def commit_month(spark: SparkSession, root: str, store: str, month: str, fmt: str = "csv") -> int:
    """Replace ``train_new`` and ``val_new`` of the versioned ``store`` with the month's files below ``root``; the new version.

    Both sets and their month change with one manifest: a reader sees the old month or the new
    one, never a mixture, and a crash before the commit leaves the old one.
    """
    if month not in FEED_MONTHS:
        raise ValueError(f"{month!r} is not a feed month, use one of {', '.join(FEED_MONTHS)}")
    sets = {f"{split}_new": read_raw(spark, f"{root.rstrip('/')}/{split}_{month}", fmt) for split in SPLITS}
    return commit(spark, store, {name: rows.withColumn("month", F.lit(month)) for name, rows in sets.items()})


def read_feed(spark: SparkSession, store: str, split: str, version: int | None = None) -> DataFrame:
    """One set of a version (the newest by default), with its month."""
    return read_version(spark, store, f"{split}_new", version)
