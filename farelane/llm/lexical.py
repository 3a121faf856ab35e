"""Ranked lexical search for many items at once: shared sets of terms are scored once per document.

Items of one block become a plan: leaves are terms (with their number in an item), inner
nodes are sums of two nodes that several items share, and an item is the sum of a few
nodes. Every document's partial scores of all nodes are made once, and items add them up.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm.shared import batches, cut, utf8
from farelane.staging import stage

#: Bytes of the terms of a block of items (or one item); bounds the plan that is broadcast.
BLOCK_BYTES = 1 << 20
#: Partial scores that a task holds at once.
CELLS = 1 << 22
#: Bytes of a text that are split at once.
PIECE = 1 << 20
#: Ranks are merged in so many parts per item first, so that no task sorts what all tasks found for an item.
SALTS = 64

# Letters, digits and all bytes beyond ASCII make terms; A-Z are lower-cased, the rest separates.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(text: bytes | None) -> Counter:
    """Terms of a text and their numbers; a very long text is split piece by piece."""
    folded, found, start = (text or b"").translate(_FOLD), Counter(), 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        found.update(folded[start:end].split())
        start = end
    return found


class Plan:
    """Leaves, shared sums and items of one block.

    ``terms[k]`` and ``times[k]`` are leaf k; node ``len(terms) + k`` is the sum of the
    earlier nodes ``pairs[k]``; item q adds up ``nodes[bounds[q]:bounds[q + 1]]``.
    """

    def __init__(self, items: list[dict[bytes, int]]):
        leaves: dict[tuple[bytes, int], int] = {}
        lists = [[leaves.setdefault(leaf, len(leaves)) for leaf in item.items()] for item in items]
        self.terms = [t for t, _ in leaves]
        self.times = np.array([n for _, n in leaves], np.int64)
        item = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        node = np.array([k for x in lists for k in x], np.int64)
        self.pairs = np.zeros((0, 2), np.int64)
        while True:
            item, node, more = self._shared(item, node, len(leaves) + len(self.pairs))
            if not len(more):
                break
            self.pairs = np.concatenate((self.pairs, more))
        order = np.argsort(item, kind="stable")
        self.nodes = node[order]
        self.bounds = np.searchsorted(item[order], np.arange(len(lists) + 1))
        depth = np.zeros(len(leaves) + len(self.pairs), np.int64)
        for k, (a, b) in enumerate(self.pairs.tolist()):
            depth[len(leaves) + k] = max(depth[a], depth[b]) + 1
        self.layers = [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]

    @staticmethod
    def _shared(item: np.ndarray, node: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Replaces pairs of nodes that several items hold side by side by their sum: (item, node, new pairs).

        Nodes of an item stand by how many items hold them, and by which, so sets that
        items share stand side by side. Of overlapping pairs the commoner one is taken.
        """
        none = np.zeros((0, 2), np.int64)
        if not len(node):
            return item, node, none
        common = np.bincount(node, minlength=size)
        mark = (np.arange(int(item.max()) + 1, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mark ^= mark >> np.uint64(31)
        holders = np.zeros(size, np.uint64)
        np.add.at(holders, node, mark[item] * mark[item])
        order = np.lexsort((node, holders[node], -common[node], item))
        item, node = item[order], node[order]
        side = np.flatnonzero(item[1:] == item[:-1])
        if not len(side):
            return item, node, none
        key = node[side] << 32 | node[side + 1]
        value, back, count = np.unique(key, return_inverse=True, return_counts=True)
        if count.max() < 2:
            return item, node, none
        weight = np.full(len(node) + 1, -1, np.int64)  # of the pair that begins at a place
        rank = np.empty(len(value), np.int64)
        rank[np.lexsort((value, count))] = np.arange(len(value))
        weight[side[count[back] > 1] + 1] = rank[back[count[back] > 1]]
        best = (weight[1:-1] > weight[:-2]) & (weight[1:-1] > weight[2:]) & (weight[1:-1] >= 0)
        chosen = np.flatnonzero(best)
        names, again, times = np.unique(node[chosen] << 32 | node[chosen + 1], return_inverse=True, return_counts=True)
        if not (times > 1).any():  # every pair gave way somewhere: the commonest goes first
            chosen = side[key == value[np.lexsort((value, count))[-1]]]
            names, again, times = np.unique(node[chosen] << 32 | node[chosen + 1], return_inverse=True, return_counts=True)
        new = np.cumsum(times > 1) - 1 + size
        use = times[again] > 1
        node = node.copy()
        node[chosen[use]] = new[again[use]]
        rest = np.ones(len(node), bool)
        rest[chosen[use] + 1] = False
        made = names[times > 1]
        return item[rest], node[rest], np.stack([made >> 32, made & 0xFFFFFFFF], axis=1)

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        """Sums of every item from the ``(leaf, document)`` scores; each shared node is added once."""
        n = len(self.terms)
        acc = np.zeros((n + len(self.pairs) + 1, leaves.shape[1]), np.int64)
        acc[:n] = leaves
        for layer in self.layers:
            a, b = self.pairs[layer - n].T
            acc[layer] = acc[a] + acc[b]
        out = np.zeros((len(self.bounds) - 1, leaves.shape[1]), np.int64)
        some = np.flatnonzero(np.diff(self.bounds))
        if len(some):
            out[some] = np.add.reduceat(acc[self.nodes], self.bounds[some], axis=0)
        return out


def _tokenized(vocabulary: dict[bytes, int]):
    def run(source):
        def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            keep, sizes, ends, found, times = [], [], [0], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                held = terms(text)
                if held:
                    keep.append(k)
                    sizes.append(held.total())
                    for t in held.keys() & vocabulary.keys():
                        found.append(vocabulary[t])
                        times.append(held[t])
                    ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, pa.int32())) for v in (found, times)]
            return pa.record_batch([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), *lists], names=["i", "n", "term", "tf"])

        yield from batches(one)(source)

    return run


def _impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: int, words: int) -> np.ndarray:
    """Score of terms that occur ``tf`` times in documents of ``n`` terms."""
    if 75 * int(n.max(initial=0)) * docs < 1 << 63:
        m = 25 + 75 * n * docs // words
    else:
        m = np.array([25 + 75 * int(x) * docs // words for x in n], np.int64)
    return w * (1_000_000_000 * tf // (1000 * tf + 8 * m))


class _Best:
    """The best documents of every item so far: score, and id in ascending order where scores tie; null ids last."""

    def __init__(self, most: int):
        self.most = most
        self.rows = np.zeros((4, 0), np.int64)  # item, -score, whether the id is null, id

    def floor(self, items: int) -> np.ndarray:
        """The score that an item's candidates must reach."""
        out = np.ones(items, np.int64)
        count = np.bincount(self.rows[0], minlength=items)
        full = np.flatnonzero(count == self.most)
        out[full] = -self.rows[1][np.cumsum(count)[full] - 1]
        return out

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        if not len(item):
            return
        rows = np.concatenate((self.rows, np.stack([item, -score, null, doc])), axis=1)
        rows = rows[:, np.lexsort(rows[::-1])]
        start = np.searchsorted(rows[0], rows[0], side="left")
        self.rows = rows[:, np.arange(rows.shape[1]) - start < self.most]


def _best_documents(plan: Plan, weights: np.ndarray, names: list, docs: int, words: int, most: int):
    """Scores all documents of a partition and yields the best ones of every item."""
    vocabulary = {t: k for k, t in enumerate(dict.fromkeys(plan.terms))}
    of_leaf = np.array([vocabulary[t] for t in plan.terms], np.int64)
    at_once = max(1, CELLS // (len(plan.terms) + len(plan.pairs) + len(names) + 1))

    def run(source):
        best = _Best(most)
        for batch in source:
            ids, n = batch.column(0), batch.column(1).to_numpy()
            null, doc = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            bounds = batch.column(2).offsets.to_numpy()
            term, tf = (batch.column(c).values.to_numpy().astype(np.int64) for c in (2, 3))
            for low in range(0, len(n), at_once):
                high = min(low + at_once, len(n))
                a, b = bounds[low], bounds[high]
                owner = np.repeat(np.arange(high - low), np.diff(bounds[low : high + 1]))
                table = np.zeros((len(vocabulary), high - low), np.int64)
                table[term[a:b], owner] = _impacts(weights[term[a:b]], tf[a:b], n[low:high][owner], docs, words)
                scores = plan.scores(table[of_leaf] * plan.times[:, None])
                item, at = np.nonzero(scores >= best.floor(len(names))[:, None])
                best.add(item, scores[item, at], null[low:high][at].astype(np.int64), doc[low:high][at])
        item, score, null, doc = best.rows
        if len(item):
            yield pa.record_batch(
                [pa.array([names[q][0] for q in item]), pa.array([names[q][1] for q in item], pa.int64()), pa.array(doc, mask=null.astype(bool)), pa.array(-score)],
                names=["q", "item", "doc", "score"],
            )

    return run


def _ranked(rows: DataFrame, *by: Column | str) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q", *by).orderBy(F.desc("score"), F.asc_nulls_last("doc"))))


def search(
    docs: DataFrame, items: DataFrame, most: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(item_col, rank, id_col, score)``: the ``most`` documents of highest score for every item, if above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. With
    N documents that have a term, L terms in all, n of them in a document and df documents
    that hold a term, a term weighs ``floor(1000 ln((2 N + 2) / (2 df + 1)))`` and scores that times
    ``10^9 tf div (1000 tf + 8 m)``, with ``m = 25 + (75 n N) div L``; an item's terms add up, repeats
    included. Equal scores stand by ascending id, null ids last. Repeated documents and items are
    rows of their own; null or empty texts have no terms; no documents or no items give no rows.

    Items are dealt into blocks of about ``block_bytes`` of terms. A block's plan is made in a task and sent to
    all; each block reads the texts once and keeps, of every document, the numbers of the terms
    that its items have. Tasks return at most ``most`` rows per item, merged in parts.
    """
    spark = docs.sparkSession
    schema = f"{item_col} long, rank int, {id_col} long, score long"
    asked = items.select(F.monotonically_increasing_id().alias("q"), F.col(item_col).cast("long").alias("item"), utf8(item_text_col).alias("t"))
    asked = cut(asked)
    size = asked.agg(F.sum(F.coalesce(F.length("t"), F.lit(0)) + F.lit(16))).first()[0]
    if not size:
        return spark.createDataFrame([], schema)
    blocks = -(-size // block_bytes)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int"))
    source = docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t"))
    parts = []
    for block in range(blocks):
        found = _search_block(source, asked.filter(F.col("block") == block), most)
        if found is not None:
            parts.append(found)
    if not parts:
        return spark.createDataFrame([], schema)
    found = reduce(DataFrame.unionByName, parts)
    some = _ranked(found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SALTS))), "part").filter(F.col("rank") <= most)
    last = _ranked(some.drop("rank")).filter(F.col("rank") <= most)
    return last.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")


def _make_plan(table: pa.Table) -> pa.Table:
    """The block's items without their texts, and the plan over them, as one row."""
    held = [terms(t) for t in table.column("t").to_pylist()]
    names = list(zip(table.column("q").to_pylist(), table.column("item").to_pylist()))
    return pa.table({"plan": pa.array([pickle.dumps((names, Plan(held)))], pa.binary())})


def _search_block(source: DataFrame, asked: DataFrame, most: int) -> DataFrame | None:
    made = asked.groupBy("block").applyInArrow(_make_plan, "plan binary").first()
    if made is None:
        return None
    names, plan = pickle.loads(made["plan"])
    vocabulary = {t: k for k, t in enumerate(dict.fromkeys(plan.terms))}
    held = stage(source.mapInArrow(_tokenized(vocabulary), "i long, n long, term array<int>, tf array<int>"), "terms")
    total = held.agg(F.count("*").alias("docs"), F.sum("n").alias("words")).first()
    if not total["docs"] or not vocabulary:
        return None
    df = np.zeros(len(vocabulary), np.int64)
    for r in held.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # at most one row per term of the block
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * int(k) + 1))) for k in df], np.int64)
    run = _best_documents(plan, weights, names, total["docs"], total["words"], most)
    return held.mapInArrow(run, "q long, item long, doc long, score long")
