"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from farelane.llm.contamination import words_of
from farelane.llm.shared import batches, pack, utf8

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Spec:
    """Everything that shapes a fit.

    ``sample``: labelled rows a fit learns from, at most about so many, taken by a
    hash of the id; scoring and all else covers every row. ``shards``: independent
    learners, averaged; one task each. ``bits``: width of the feature hash, 32 at most. ``alpha`` and ``beta``
    set the per-coordinate rates, ``l1`` and ``l2`` the penalties; ``l1`` holds for a full
    sample and falls with the root of the rows learnt from. All of this is one rule at
    every size.
    """

    sample: int = 16_000
    shards: int = 1
    epochs: int = 3
    bits: int = 32
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.1


class Words:
    """Hashes of words, remembered; the memory is emptied when it is full and changes no result."""

    def __init__(self, most: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in {*words}.difference(known):
            known[w] = xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray, bits: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M2
    return x >> np.uint64(64 - bits)


def features(words: np.ndarray, bits: int) -> np.ndarray:
    """Hashed single words, neighbours, and pairs that skip one word, repeats included."""
    return np.concatenate(
        [_mix(words * _M1, bits), _mix(words[:-1] * _M2 + words[1:] * _M3, bits), _mix(words[:-2] * _M3 + words[2:] * _M1 + _M1, bits)]
    )


@dataclass(frozen=True)
class ToxicModel:
    """Non-zero weights by feature hash, sorted; small enough to broadcast (bounded by the sample)."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    spec: Spec = field(default_factory=Spec)

    def scores(self, texts: list[bytes | None], words: Words) -> np.ndarray:
        docs = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, docs), np.int64, len(docs))
        total = np.full(len(docs), self.bias)
        if len(self.keys) and counts.sum():
            ids = words([w for d in docs for w in d])
            doc = np.repeat(np.arange(len(docs)), counts)
            seen = np.zeros(1 << 16, bool)
            seen[self.keys & np.uint64(0xFFFF)] = True
            hits, owners = [], []
            for part, gap in ((_mix(ids * _M1, self.spec.bits), 0), (_mix(ids[:-1] * _M2 + ids[1:] * _M3, self.spec.bits), 1), (_mix(ids[:-2] * _M3 + ids[2:] * _M1 + _M1, self.spec.bits), 2)):
                near = np.flatnonzero(seen[(part & np.uint64(0xFFFF)).astype(np.int64)])
                if gap:
                    near = near[doc[near] == doc[near + gap]]
                place = np.minimum(np.searchsorted(self.keys, part[near]), len(self.keys) - 1)
                true = self.keys[place] == part[near]
                hits.append(place[true])
                owners.append(doc[near[true]])
            pair = np.unique(np.concatenate(owners) * len(self.keys) + np.concatenate(hits))  # a feature counts once
            np.add.at(total, pair // len(self.keys), self.weights[pair % len(self.keys)])
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def ftrl(rows: list[np.ndarray], labels: np.ndarray, spec: Spec, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over one shard: ``(keys, weights, bias)`` of the non-zero weights.

    A gradient is below one, so a feature of no more than ``l1 / epochs`` rows keeps a
    zero weight all the way and never adds to a sum: such features are left out from the start, which
    changes no result.
    """
    l1 = spec.l1 * min(1.0, len(rows) * spec.shards / spec.sample) ** 0.5  # evidence grows with the rows
    every = np.concatenate(rows) if len(rows) else np.zeros(0, np.uint32)
    every.sort()
    often = int(l1 // spec.epochs)
    keys = np.unique(every[: len(every) - often][every[: len(every) - often] == every[often:]]) if len(every) > often else every[:0]
    del every
    bias = len(keys)
    at = []
    for row in rows:
        place = np.searchsorted(keys, row)
        known = keys[np.minimum(place, max(bias - 1, 0))] == row if bias else np.zeros(len(row), bool)
        at.append(np.append(place[known], bias).astype(np.int32))
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weight(i: np.ndarray) -> np.ndarray:
        limit, zi = np.where(i == bias, 0.0, l1), z[i]
        return np.where(np.abs(zi) <= limit, 0.0, (np.sign(zi) * limit - zi) / ((spec.beta + np.sqrt(n[i])) / spec.alpha + spec.l2))

    order = np.random.default_rng(seed)
    for _ in range(spec.epochs):
        for r in order.permutation(len(rows)):
            i = at[r]
            w = weight(i)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[r]
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / spec.alpha
            z[i] += g - step * w
            n[i] += g * g
    w = weight(np.arange(bias + 1))
    use = np.flatnonzero(w[:bias])
    return keys[use].astype(np.uint64), w[use], float(w[bias])


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column | None = None, spec: Spec = Spec(),
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicModel:
    """Learn from labelled rows of ``docs``; ``learn`` says which ids may be used.

    Rows without a label (none, null) or id are not learnt from; an id with several
    labels counts as toxic when one says so. With no usable rows the model is a
    constant 0 score below one half. At most about ``spec.sample`` rows are learnt
    from, whatever the size of the tables; their ids and labels are broadcast, so texts are not
    shuffled; each shard is one task, and the driver receives non-zero weights only. Very long texts give each feature once; columns beside
    the three named ones are not read, whatever their names.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("i"), F.col(label_col).cast("int").alias("y"))
    marked = marked.filter("i IS NOT NULL AND y IS NOT NULL").groupBy("i").agg(F.max("y").alias("y"))
    if learn is not None:
        marked = marked.withColumnRenamed("i", id_col).filter(learn).withColumnRenamed(id_col, "i")
    total = marked.count()
    if total > spec.sample:
        share = int(spec.sample / total * (1 << 32))
        marked = marked.filter(F.shiftrightunsigned(F.xxhash64("i"), 32) < share)
    source = docs.select(F.col(id_col).cast("long").alias("d"), utf8(text_col).alias("t"))
    source = source.join(F.broadcast(marked), F.col("d") == F.col("i")).select("d", "y", "t")

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [pack(np.unique(features(words(words_of(t)), spec.bits)).astype(np.uint32)) for t in batch.column(2).to_pylist()]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["d", "y", "f"])

    words = Words()
    rows = source.mapInArrow(batches(extract), "d long, y int, f binary")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("d", F.lit(1)), F.lit(spec.shards)))

    def learn_shard(key: tuple, table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [("d", "ascending"), ("f", "ascending")]).to_numpy()
        features_ = table["f"]
        rows = [np.frombuffer(features_[int(r)].as_buffer(), np.uint32) for r in order]  # views, no copies
        k, w, b = ftrl(rows, table["y"].to_numpy()[order].astype(float), spec, key[0].as_py())
        return pa.table({"k": np.append(k, np.uint64(0)).view(np.int64), "w": np.append(w, b), "bias": np.append(np.zeros(len(k), bool), True)})

    learnt = rows.groupBy("shard").applyInArrow(learn_shard, "k long, w double, bias boolean")
    got = learnt.groupBy("bias", "k").agg(F.sum("w").alias("w"), F.count("*").alias("n")).toPandas()
    base = got[got["bias"]]
    if not len(base):
        return ToxicModel(np.zeros(0, np.uint64), np.zeros(0), -5.0, spec)
    shards = int(base["n"].iloc[0])
    own = got[~got["bias"]]
    keys, weights = own["k"].to_numpy(np.int64).view(np.uint64), own["w"].to_numpy() / shards
    order = np.argsort(keys)
    return ToxicModel(keys[order], weights[order], float(base["w"].iloc[0]) / shards, spec)


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score, predicted)`` of every row from its whole text, in one pass.

    Null and empty texts score as the bias alone does; repeated rows score alike; an
    empty table gives no rows. Very long texts are scored whole; extra columns are not read.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t"))

    def run(source):
        words, model = Words(), held.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            s = model.scores(batch.column(1).to_pylist(), words)
            return pa.record_batch([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["i", "score", "predicted"])

        yield from batches(one)(source)

    return source.mapInArrow(run, "i long, score double, predicted int").withColumnRenamed("i", id_col)


def keep_clean(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model doesn't call toxic, all columns as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(source):
        words, model = Words(), held.value

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            s = model.scores([None if t is None else t.encode() for t in texts], words)
            return batch.filter(pa.array(s < 0.5))

        yield from batches(one)(source)

    return docs.mapInArrow(run, docs.schema)
