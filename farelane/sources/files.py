"""Reading and writing trip tables as files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions import parse_utc
from farelane.schema import PROCESSED, RAW, RAW_TEXT


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", header: bool = True) -> DataFrame:
    """Raw trips. Text columns are named by position and typed by declaration; a field
    that does not parse becomes null, and so falls to the missing-value rule. ``fmt``
    ``table`` opens the catalog table of that name."""
    if fmt == "csv":
        text = spark.read.schema(RAW_TEXT).option("header", header).option("mode", "PERMISSIVE").csv(path)
        return conform(text.withColumn("pickup_datetime", parse_utc(F.col("pickup_datetime"))), RAW)
    return conform(spark.table(path) if fmt == "table" else spark.read.format(fmt).load(path), RAW)


def read_processed(spark: SparkSession, path: str, fmt: str = "parquet", header: bool = True, months: bool = False) -> DataFrame:
    """The 66 float columns, features first and the fare last.

    ``months`` adds the folder columns ``year`` and ``month`` of a table written by
    month, so that a filter on them prunes the scan. ``fmt`` ``table`` opens a catalog table.
    """
    if fmt == "table":
        opened = spark.table(path)
    elif fmt == "csv":
        opened = spark.read.schema(PROCESSED).option("header", header).csv(path)
    else:
        opened = spark.read.schema(PROCESSED).format(fmt).load(path)
    return opened.select(*PROCESSED.names, *(("year", "month") if months else ()))


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Select the declared columns in order, cast to the declared types."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields))


def schema_differences(df: DataFrame, declared: T.StructType) -> list[tuple[int, str, str, str]]:
    """``(position, column, declared, actual)`` wherever name or type differ."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for i, f in enumerate(declared.fields):
        found = actual.get(f.name, "missing")
        in_place = i < len(df.columns) and df.columns[i] == f.name
        if found != f.dataType.simpleString() or not in_place:
            out.append((i, f.name, f.dataType.simpleString(), found))
    return out


def check_schema(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Return ``df`` when it has exactly the declared columns and types, else raise."""
    wrong = schema_differences(df, declared)
    extra = [c for c in df.columns if c not in declared.names]
    if wrong or extra:
        raise TypeError(f"schema differs: {wrong}, unexpected columns: {extra}")
    return df


def unreadable_fields(text: DataFrame, declared: T.StructType = RAW_TEXT) -> DataFrame:
    """``(column, type, filled, unreadable)``: how many text values do not parse as declared.

    ``text`` has every column as string; one pass.
    """
    lines = []
    for f in declared.fields:
        value = F.col(f.name)
        parsed = parse_utc(value) if f.name == "pickup_datetime" else value.try_cast(f.dataType)
        lines.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit("timestamp_ntz" if f.name == "pickup_datetime" else f.dataType.simpleString()).alias("type"),
                F.count(value).alias("filled"),
                F.count_if(value.isNotNull() & parsed.isNull()).alias("unreadable"),
            )
        )
    return text.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def write_dataset(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    table: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Write to a path or, with ``table``, to a catalog table.

    ``overwrite`` replaces, ``append`` adds. Columns whose names do not start with a
    letter or underscore get a ``_`` in front. With ``partition_by`` the rows are
    rebalanced on those columns: Spark splits large partitions and joins small ones,
    so one hot month is not one task and small months are not one file per task.
    """
    names = [c if c[:1].isalpha() or c.startswith("_") else f"_{c}" for c in df.columns]
    out = df.toDF(*names)
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        # the default text format stops at milliseconds
        writer = writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table:
        writer.saveAsTable(target)
    else:
        writer.save(target)
