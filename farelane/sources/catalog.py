"""A catalog of sized datasets: ``(split, size, zone, format, path)``."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.schema import SIZES
from farelane.sources.files import read_processed, read_raw, write_dataset

CATALOG = T.StructType(
    [T.StructField(n, T.StringType(), False) for n in ("split", "size", "zone", "format", "path")]
)
SPLITS = ("train", "val")
ZONES = ("raw", "processed")


def dataset_name(split: str, size: str, zone: str) -> str:
    """``train_1k`` for raw, ``train_processed_1k`` for processed data."""
    return f"{split}_{size}" if zone == "raw" else f"{split}_{zone}_{size}"


def make_catalog(spark: SparkSession, entries: Iterable[tuple[str, str, str, str, str]]) -> DataFrame:
    """A catalog of checked entries, each dataset listed once."""
    rows = list(entries)
    for split, size, zone, _, _ in rows:
        if split not in SPLITS or size not in SIZES or zone not in ZONES:
            raise ValueError(f"unknown dataset: {dataset_name(split, size, zone)}")
    if len({r[:3] for r in rows}) != len(rows):
        raise ValueError("a dataset is listed twice")
    return spark.createDataFrame(rows, CATALOG)


def resolve(catalog: DataFrame, split: str, size: str, zone: str) -> tuple[str, str]:
    """Format and path of one dataset."""
    found = catalog.filter((F.col("split") == split) & (F.col("size") == size) & (F.col("zone") == zone)).first()
    if found is None:
        raise LookupError(f"no dataset {dataset_name(split, size, zone)}")
    return found["format"], found["path"]


def read_dataset(catalog: DataFrame, split: str, size: str, zone: str) -> DataFrame:
    """Open a dataset with its zone's declared schema; format ``table`` names a catalog table in ``path``."""
    fmt, path = resolve(catalog, split, size, zone)
    reader = read_raw if zone == "raw" else read_processed
    return reader(catalog.sparkSession, path, fmt)


def _entries(catalog: DataFrame) -> list:
    return catalog.orderBy("zone", "split", "size").collect()


def load_sizes(catalog: DataFrame, root: str) -> DataFrame:
    """Load every listed file with inferred types into ``root``; returns the new catalog.

    Replaces what was there. The only reader that infers types.
    """
    spark = catalog.sparkSession
    loaded = []
    for e in _entries(catalog):
        reader = spark.read
        if e["format"] == "csv":
            reader = reader.option("header", True).option("inferSchema", True)
        df = spark.table(e["path"]) if e["format"] == "table" else reader.format(e["format"]).load(e["path"])
        target = f"{root.rstrip('/')}/{dataset_name(e['split'], e['size'], e['zone'])}"
        write_dataset(df, target, "overwrite")
        loaded.append((e["split"], e["size"], e["zone"], "parquet", target))
    return make_catalog(spark, loaded)


def inventory(catalog: DataFrame) -> DataFrame:
    """``(dataset, zone, rows, first_pickup, last_pickup)`` of every listed dataset.

    One branch per dataset, united into a single job; processed data has no times.
    """
    parts = []
    for e in _entries(catalog):
        df = read_dataset(catalog, e["split"], e["size"], e["zone"])
        timed = e["zone"] == "raw"
        none = F.lit(None).cast("timestamp_ntz")
        parts.append(
            df.agg(
                F.count("*").alias("rows"),
                (F.min("pickup_datetime") if timed else none).alias("first_pickup"),
                (F.max("pickup_datetime") if timed else none).alias("last_pickup"),
            ).select(
                F.lit(dataset_name(e["split"], e["size"], e["zone"])).alias("dataset"),
                F.lit(e["zone"]).alias("zone"),
                "rows",
                "first_pickup",
                "last_pickup",
            )
        )
    return reduce(DataFrame.unionByName, parts)
