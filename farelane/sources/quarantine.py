"""Text files of raw trips whose malformed lines are set aside with file and reason instead of lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.functions import parse_utc
from farelane.schema import RAW, RAW_TEXT
from farelane.sources.files import conform

_CORRUPT = "_corrupt"
_SOUND, _BAD = "sound", "quarantined"
#: A quoted field, with escaped quotes inside.
_QUOTED = r'"(?:[^"\\]|\\.)*+"'


def _fields(line: Column) -> Column:
    """How many fields a line has: its commas outside quotes, and one."""
    bare = F.regexp_replace(line, _QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def checked_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Every line as a raw trip with ``_line``, ``_file``, ``_reason`` and ``_fields``; ``_reason`` is null for sound lines.

    Lines are parsed in PERMISSIVE mode with a column for corrupt records. ``short`` and
    ``long`` lines have too few or too many fields; ``unreadable`` ones a filled field that does not parse
    as declared, named in ``_fields``. Empty lines are no records; with ``header`` neither are lines that equal
    the header. An empty field is null and sound.
    """
    declared = T.StructType([*RAW_TEXT.fields, T.StructField(_CORRUPT, T.StringType())])
    lines = spark.read.text(path).select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file")).filter(F.trim("_line") != "")
    if header:
        lines = lines.filter(F.col("_line") != ",".join(RAW_TEXT.names))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.withColumn("t", F.from_csv("_line", declared.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options))
    when = parse_utc(F.col("t.pickup_datetime"))
    count = _fields(F.col("_line"))
    unread = F.col("t.pickup_datetime").isNotNull() & when.isNull()
    reason = (
        F.when(count < len(RAW_TEXT), "short").when(count > len(RAW_TEXT), "long").when(F.col(f"t.{_CORRUPT}").isNotNull() | unread, "unreadable")
    )
    text = F.from_csv("_line", ", ".join(f"{n} string" for n in RAW_TEXT.names), {"mode": "PERMISSIVE"})
    bad = [
        F.when(text[f.name].isNotNull() & (when if f.name == "pickup_datetime" else F.col(f"t.{f.name}")).isNull(), F.lit(f.name))
        for f in RAW_TEXT.fields
    ]
    named = F.when(reason == "unreadable", F.concat_ws(",", *bad))
    trips = parsed.select("_line", "_file", reason.alias("_reason"), named.alias("_fields"), "t.*")
    typed = trips.withColumn("pickup_datetime", parse_utc(F.col("pickup_datetime")))
    return conform(typed, T.StructType([*RAW.fields, *(T.StructField(c, T.StringType()) for c in ("_line", "_file", "_reason", "_fields"))]))


def ingest_checked(spark: SparkSession, path: str, target: str, header: bool = True) -> None:
    """Parse text files once into ``target``: sound trips, and quarantined lines, each in a folder of its own."""
    lines = checked_lines(spark, path, header)
    bad = F.col("_reason").isNotNull()
    out = lines.select(
        *(F.when(~bad, F.col(n)).alias(n) for n in RAW.names), *(F.when(bad, F.col(n)).alias(n) for n in ("_line", "_file", "_reason", "_fields")),
        F.when(bad, _BAD).otherwise(_SOUND).alias("status"),
    )
    out.write.mode("overwrite").partitionBy("status").parquet(target)


def _read(spark: SparkSession, target: str, status: str) -> DataFrame:
    stored = T.StructType([*RAW.fields, *(T.StructField(c, T.StringType()) for c in ("_line", "_file", "_reason", "_fields", "status"))])
    return spark.read.schema(stored).parquet(target).filter(F.col("status") == status)


def read_sound(spark: SparkSession, target: str) -> DataFrame:
    """The trips of all sound lines."""
    return _read(spark, target, _SOUND).select(*RAW.names)


def read_quarantined(spark: SparkSession, target: str) -> DataFrame:
    """``(file, line, reason, fields)`` of every malformed line."""
    return _read(spark, target, _BAD).select(*(F.col(f"_{n}").alias(n) for n in ("file", "line", "reason", "fields")))
