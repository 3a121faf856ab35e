"""Token-count totals kept by signed deltas, committed in idempotent batches."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm.shared import utf8
from farelane.staging import create_new, names_in, read_small, remove_folder

KEYS = ("source", "lang", "tokenizer")
_SUMS = "source string, lang string, tokenizer string, docs long, tokens long"
#: Actions and what they do to the totals: (sign of the old counts, sign of the new ones).
ACTIONS = {"insert": (0, 1), "delete": (-1, 0), "revise": (-1, 1)}


def counted(docs: DataFrame, counters: Mapping[str, Column], source: str = "source", lang: str = "lang") -> DataFrame:
    """``(source, lang, tokenizer, tokens)``: a row for each document and tokenizer version.

    ``counters`` names each version and gives its count as a column of ``docs``; null counts are 0.
    """
    each = F.array(*(F.struct(F.lit(k).alias("tokenizer"), F.coalesce(c.cast("long"), F.lit(0)).alias("tokens")) for k, c in counters.items()))
    return docs.select(F.col(source).alias("source"), F.col(lang).alias("lang"), F.explode(each).alias("e")).select("source", "lang", "e.tokenizer", "e.tokens")


def changes(action: str, new: DataFrame | None = None, old: DataFrame | None = None) -> DataFrame:
    """Signed rows ``(source, lang, tokenizer, docs, tokens)`` of counted rows that come, go, or replace others.

    A revision takes the old counts away and adds the new ones, so a document may
    change its source, language or tokenizer version as well.
    """
    minus, plus = ACTIONS[action]
    side = lambda df, sign, n: df.select(*KEYS, F.lit(n).cast("long").alias("docs"), (F.col("tokens") * sign).alias("tokens"))
    parts = [side(df, sign, sign) for df, sign in ((old, minus), (new, plus)) if sign]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def word_counts(docs: DataFrame, versions: Mapping[str, Callable[[bytes], int]], text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with a column of counts for each version; each text is read once.

    A version counts the tokens of UTF-8 bytes. Null reads as empty.
    """
    kept = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(v, T.LongType()) for v in versions)])
    source = docs.select(*kept, utf8(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(len(kept)).to_pylist()]
            counts = [pa.array([count(t) for t in texts], pa.int64()) for count in versions.values()]
            yield pa.record_batch([*batch.columns[: len(kept)], *counts], names=schema.names)

    return source.mapInArrow(run, schema)


def _digest(sums: DataFrame) -> str:
    """What tells one batch from another, whatever the order of its rows."""
    n, mark = sums.agg(F.count("*"), F.sum(F.xxhash64(*sums.columns).cast("decimal(38,0)"))).first()
    return f"{n}:{mark or 0}"


def _manifest(spark: SparkSession, path: str, batch: int) -> dict:
    return json.loads(read_small(spark, f"{path}/batches/{int(batch):012d}"))


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed batches."""
    return [int(n) for n in names_in(spark, f"{path}/batches")]


def _put(spark: SparkSession, path: str, batch: int, folders: list[str], digest: str) -> None:
    """Commit a batch by one small file, unless it is there already; another one of its number is refused."""
    if create_new(spark, f"{path}/batches/{int(batch):012d}", json.dumps({"folders": folders, "digest": digest})):
        return
    for f in folders:
        remove_folder(spark, f"{path}/sums/{f}")
    if _manifest(spark, path, batch)["digest"] != digest:
        raise ValueError(f"batch {batch} is committed with other contents")


def commit(delta: DataFrame, path: str, batch: int) -> None:
    """Put the sums of a batch of signed rows in place.

    Sums are combined before the shuffle and written aside; one small file, made only if there
    is none of that number, adds them to the totals, so a reader sees all of a batch or
    nothing. A retry or a second delivery changes nothing; a batch with other sums under a
    number that is taken raises. Batches may arrive in any order; an empty one adds nothing.
    """
    spark = delta.sparkSession
    sums = delta.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    folder = f"{int(batch)}-{uuid.uuid4().hex}"
    sums.write.parquet(f"{path}/sums/{folder}")
    written = spark.read.schema(_SUMS).parquet(f"{path}/sums/{folder}")
    _put(spark, path, batch, [folder], _digest(written))


def _rows(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    folders = [f for b in numbers for f in _manifest(spark, path, b)["folders"]]
    if not folders:
        return spark.createDataFrame([], _SUMS)
    return spark.read.schema(_SUMS).parquet(*(f"{path}/sums/{f}" for f in folders))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """``(source, lang, tokenizer, docs, tokens)``: the sum of all committed batches.

    A null source or language is a group of its own; a group whose documents are all
    gone stays, with zeros; no batches give no rows.
    """
    rows = _rows(spark, path, batches(spark, path))
    return rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


def compact(spark: SparkSession, path: str, target: str, through: int) -> None:
    """A store below ``target`` with the sums of all batches up to ``through`` folded into one folder; later ones are copied as they are.

    The numbers of folded batches stay taken, so a late second delivery still changes nothing.
    """
    known = batches(spark, path)
    early = [b for b in known if b <= through]
    for part in [early, *([b] for b in known if b > through)]:
        if not part:
            continue
        folder = f"{part[-1]}-{uuid.uuid4().hex}"
        sums = _rows(spark, path, part).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.parquet(f"{target}/sums/{folder}")
        for b in part:
            _put(spark, target, b, [folder] if b == part[-1] else [], _manifest(spark, path, b)["digest"])
