"""A training corpus from raw documents: five stages, each applying one operator of ``farelane.llm``.

Every function takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but the
last return the columns of ``docs``; each judges only what its predecessor kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import bpe, contamination, secrets, simhash, toxicity
from farelane.llm.shared import cut, folder
from farelane.staging import remove_folder

#: Names of helper columns; long, so that no column of the input has them.
_ID, _SIZE = "__pipeline_id", "__pipeline_chars"
_MARK, _HASH, _FIRST = "__pipeline_mark", "__pipeline_hash", "__pipeline_first"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of documents still here."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies one row stays, of the smallest id; rows without an id stay, too.

    Rows are judged each: equal rows are copies of each other, and an id that stands on
    several texts loses only those that are copies. Of different rows of the smallest id
    the one with the least hash stays.
    """
    mark = F.xxhash64(*docs.columns)
    much = cut(simhash.surplus(docs, mark).select(F.col("i").alias(_ID), F.col("mark").alias(_MARK), F.col("first").alias(_FIRST)))
    marked = docs.withColumn(_HASH, mark)
    same = (F.col("doc_id").cast("long") == F.col(_ID)) & (F.col(_HASH) == F.col(_MARK))
    kept = marked.join(much, same, "left_anti").select(*docs.columns)
    again = much.filter(F.col(_FIRST))
    if again.isEmpty():
        return kept
    return kept.unionByName(marked.join(again, same, "left_semi").dropDuplicates(["doc_id", _HASH]).select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words stand in benchmark windows go."""
    return contamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; ``n_chars`` follows where the text has changed."""
    marked = secrets.redact(docs.withColumn(_SIZE, F.char_length("text")))
    changed = F.char_length("text") != F.col(_SIZE)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        marked = marked.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return marked.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their count and digests, encoded and decoded by byte-level BPE."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.tokenize(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("encoding", encode),
]

#: Hashes of shingles, a trained model and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    A stage's copy is removed once the next one is written; the last one stays, as the result reads it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base, last = f"{folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove_folder(spark, last)
        last = path
    return docs
