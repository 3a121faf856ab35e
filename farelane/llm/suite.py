"""The registered text queries: each applies one operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelane.llm import bpe, bwt, contamination, lexical, packing, recompression, rollups, secrets, simhash, toxicity, vectors, warc, whitening
from farelane.staging import new_folder, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_DIGITS = b"0123456789"
_NO_WORD = bytes(b if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _words_1(text: bytes) -> int:
    """A word tokenizer: runs without white space."""
    return len(text.split())


def _words_2(text: bytes) -> int:
    """Another version of it: runs of letters, digits and non-ASCII characters."""
    return len(text.translate(_NO_WORD).split())


#: Folds of the toxicity labels: remainder 0 is held out.
FOLDS = 5


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


@query
def op1_simhash(spark, folder):
    return simhash.near_classes(table(spark, folder, "documents"))


@query
def op2_decontaminate(spark, folder):
    return contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_vectors(spark, folder):
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query
def op4_warc(spark, folder):
    pages = table(spark, folder, "pages").withColumn("time", F.timestamp_seconds("page_id").cast("timestamp_ntz"))
    return warc.archive_pages(pages, new_folder(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op5_recompression(spark, folder):
    return recompression.dedup_words(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_secrets(spark, folder):
    return secrets.scan_secrets(table(spark, folder, "documents"))


@query
def op7_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"), learn=fold() != 0)
    return toxicity.score(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


@query
def op8_rollups(spark, folder):
    """Totals after four batches: all documents come, one source is withdrawn, the German texts are counted
    anew without digits, and the withdrawal is delivered a second time."""
    versions = {"n1": _words_1, "n2": _words_2, "fewer1": lambda t: _words_1(t.translate(None, _DIGITS)), "fewer2": lambda t: _words_2(t.translate(None, _DIGITS))}
    docs = stage(rollups.word_counts(table(spark, folder, "documents").select("source", "lang", "text"), versions), "counts")
    count = lambda df, name: rollups.counted(df, {"words.1": F.col(f"{name}1"), "words.2": F.col(f"{name}2")})
    german, gone = docs.filter("lang = 'de' AND NOT (source <=> 'src3')"), docs.filter("source = 'src3'")
    path = new_folder(spark, "rollups")
    rollups.commit(rollups.changes("insert", count(docs, "n")), path, 1)
    withdrawn = rollups.changes("delete", old=count(gone, "n"))
    rollups.commit(withdrawn, path, 2)
    rollups.commit(rollups.changes("revise", count(german, "fewer"), count(german, "n")), path, 3)
    rollups.commit(withdrawn, path, 2)
    return rollups.totals(spark, path)


@query
def op9_bpe(spark, folder):
    return bpe.tokenize(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op10_bwt(spark, folder):
    return bwt.dedup_bytes(table(spark, folder, "documents"))


@query
def op11_whitening(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op12_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_lexical(spark, folder):
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
