"""Benchmark decontamination with suffix arrays over the training text."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.shared import batches, utf8

#: Words of a window.
WINDOW = 13
#: Bytes of benchmark text that a task holds at once; a larger benchmark goes through in several blocks.
BLOCK = 4 << 20

# A-Z become a-z, bytes outside [0-9a-z\x80-\xff] become blanks
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and bytes above ASCII; null has none."""
    return (text or b"").translate(_FOLD).split()


class Suffixes:
    """Suffix array over word ids (0 separates); order is exact to the first ``depth`` words."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.ids = ids
        n = len(ids)
        rank, step = ids.astype(np.int64), 1
        while True:
            after = np.zeros(n, np.int64)
            after[: max(n - step, 0)] = rank[step:]
            # a separator ends a suffix: what follows it must not decide
            after[rank == 0] = 0
            key = rank * (int(rank.max(initial=0)) + 1) + after if step < depth else rank
            order = np.argsort(key, kind="stable")
            if step >= depth:
                break
            sorted_ = key[order]
            new = np.concatenate(([0], np.cumsum(sorted_[1:] != sorted_[:-1]))) + 1 if n else np.zeros(0, np.int64)
            following = np.empty(n, np.int64)
            following[order] = new
            following[self.ids == 0] = 0
            rank, step = following, step * 2
        self.order = order[np.searchsorted(ids[order] > 0, True) :] if n else order

    def _compare(self, at: np.ndarray, queries: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Sign of suffix minus query over the query's length, for each pair."""
        sign = np.zeros(len(at), np.int8)
        for k in range(queries.shape[1]):
            live = np.flatnonzero((sign == 0) & (k < length))
            if not len(live):
                break
            where = at[live] + k
            mine = np.where(where < len(self.ids), self.ids[np.minimum(where, len(self.ids) - 1)], 0)
            sign[live] = np.sign(mine - queries[live, k])
        return sign

    def search(self, queries: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Binary search: ranges of the array whose suffixes begin with each query (rows padded to a matrix)."""
        found = []
        for right in (False, True):
            lo = np.zeros(len(queries), np.int64)
            hi = np.full(len(queries), len(self.order), np.int64)
            while (lo < hi).any():
                live = np.flatnonzero(lo < hi)
                mid = (lo[live] + hi[live]) // 2
                sign = self._compare(self.order[mid], queries[live], length[live])
                up = sign <= 0 if right else sign < 0
                lo[live[up]] = mid[up] + 1
                hi[live[~up]] = mid[~up]
            found.append(lo)
        return found[0], found[1]

    def extent(self, at: np.ndarray, texts: np.ndarray, start: np.ndarray, known: int) -> np.ndarray:
        """Length of the verbatim match between the suffixes ``at`` and the benchmark ``texts`` at ``start``."""
        size = np.full(len(at), known, np.int64)
        live = np.arange(len(at))
        while len(live):
            a, b = at[live] + size[live], start[live] + size[live]
            inside = (a < len(self.ids)) & (b < len(texts))
            live, a, b = live[inside], a[inside], b[inside]
            same = (self.ids[a] == texts[b]) & (self.ids[a] > 0)
            live = live[same]
            size[live] += 1
        return size


class Benchmark:
    """A block of benchmark items as word ids, and its windows as queries."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        vocabulary: dict[bytes, int] = {}
        flat, self.names, starts, lengths, owners = [], [], [], [], []
        for name, text in items:
            ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
            size = min(window, len(ids))
            for s in range(len(ids) - size + 1 if ids else 0):
                starts.append(len(flat) + s)
                lengths.append(size)
                owners.append(len(self.names))
            self.names.append(name)
            flat += [*ids, 0]
        self.get = vocabulary.get
        self.flat = np.array(flat or [0], np.int64)
        self.start, self.length, self.owner = (np.array(x, np.int64) for x in (starts, lengths, owners))
        width = int(self.length.max(initial=1))
        at = self.start[:, None] + np.arange(width)
        self.queries = self.flat[np.minimum(at, len(self.flat) - 1)]
        self.least = int(self.length.min(initial=window))
        self.depth = width

    def matches(self, docs: list[list[bytes]]) -> tuple[np.ndarray, ...]:
        """(document, word, item, word of the item, window, longest match) of every occurrence of a window.

        Words that no item holds cannot be in a match: they separate, and runs of
        known words shorter than the shortest window are left out of the array.
        """
        none = tuple(np.zeros(0, np.int64) for _ in range(6))
        counts = np.fromiter(map(len, docs), np.int64, len(docs))
        if not len(self.start) or not counts.sum():
            return none
        get = self.get
        ids = np.fromiter((get(w, 0) for words in docs for w in words), np.int64, int(counts.sum()))
        first = np.cumsum(counts) - counts
        doc = np.repeat(np.arange(len(docs)), counts)
        edge = np.concatenate(([True], (ids[1:] > 0) != (ids[:-1] > 0))) | np.concatenate(([True], doc[1:] != doc[:-1]))
        begin = np.flatnonzero(edge)
        size = np.diff(np.append(begin, len(ids)))
        use = (ids[begin] > 0) & (size >= self.least)
        begin, size = begin[use], size[use]
        if not len(begin):
            return none
        # the runs one after another, each closed by a separator
        offset = np.cumsum(size + 1) - size - 1
        text = np.zeros(int((size + 1).sum()), np.int64)
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        origin = np.zeros(len(text), np.int64)
        text[np.repeat(offset, size) + within] = ids[np.repeat(begin, size) + within]
        origin[np.repeat(offset, size) + within] = np.repeat(begin, size) + within
        array = Suffixes(text, self.depth)
        lo, hi = array.search(self.queries, self.length)
        hits = hi - lo
        query = np.repeat(np.arange(len(hits)), hits)
        at = array.order[np.repeat(lo, hits) + np.arange(int(hits.sum())) - np.repeat(np.cumsum(hits) - hits, hits)]
        longest = array.extent(at, self.flat, self.start[query], 0)
        where = origin[at]
        owner = self.owner[query]
        ends = np.flatnonzero(self.flat == 0)
        item_start = np.concatenate(([0], ends[:-1] + 1))[owner]
        return doc[where], where - first[doc[where]], owner, self.start[query] - item_start, self.length[query], longest


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """The benchmark, a stated query set, in blocks of about :data:`BLOCK` bytes; the driver holds one at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col(id_col).cast("long"), utf8(text_col)).toLocalIterator():
        block.append((row[0], None if row[1] is None else bytes(row[1])))
        size += len(row[1] or b"")
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Verbatim matches: ``(id_col, doc_start, item_id, item_start, window, longest)``, in words.

    One row for each place of a document at which a window of an item begins, with
    the length to which the match goes on. Documents stay where they are: every task
    builds suffix arrays over its own rows and looks the benchmark's windows up.
    """
    source = docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t"))
    spark = docs.sparkSession
    names = ["i", "doc_start", "item_id", "item_start", "window", "longest"]
    out = None
    for block in _blocks(benchmark, item_col, item_text):
        held = spark.sparkContext.broadcast(block)

        def look(source, held=held):
            bench = Benchmark(held.value, window)

            def one(batch: pa.RecordBatch) -> pa.RecordBatch:
                doc, word, item, start, size, longest = bench.matches([words_of(t) for t in batch.column(1).to_pylist()])
                ids = batch.column(0).take(pa.array(doc))
                return pa.record_batch([ids, pa.array(word), pa.array([bench.names[k] for k in item], pa.int64()), pa.array(start), pa.array(size), pa.array(longest)], names=names)

            yield from batches(one)(source)

        found = source.mapInArrow(look, ", ".join(f"{n} long" for n in names))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], ", ".join(f"{n} long" for n in names))
    return out.withColumnRenamed("i", id_col)


class _Judge:
    """Hits of batches of documents against a benchmark in blocks; built once in each task."""

    def __init__(self, blocks: list, window: int):
        self.blocks, self.window = blocks, window
        self.one = Benchmark(blocks[0].value, window) if len(blocks) == 1 else None

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """(words, hit words, names of the items with occurring windows) of each text."""
        docs = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, docs), np.int64, len(docs))
        base = np.cumsum(counts) - counts
        change = np.zeros(int(counts.sum()) + 1, np.int64)
        items: list[set[str]] = [set() for _ in docs]
        for block in self.blocks:
            bench = self.one or Benchmark(block.value, self.window)
            doc, word, item, _, size, _ = bench.matches(docs)
            np.add.at(change, base[doc] + word, 1)
            np.add.at(change, base[doc] + word + size, -1)
            for d, k in set(zip(doc.tolist(), item.tolist())):
                items[d].add("null" if bench.names[k] is None else str(bench.names[k]))
        hit = np.concatenate(([0], np.cumsum(np.cumsum(change[:-1]) > 0)))
        return counts, hit[base + counts] - hit[base], items


def is_contaminated(words: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """At least one word in twenty stands in an occurrence of a window."""
    return (hit > 0) & (20 * hit >= words)


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``(id_col, n_words, n_hit, n_items, items_sha256, contaminated)`` of every row.

    ``n_hit`` counts the words inside any occurrence of a window, ``n_items`` the
    items with occurring windows, ``items_sha256`` digests their ids (sorted as text,
    joined by commas). An item of fewer than ``window`` words is one window. Null and
    empty texts have no words; an item with a null id is listed as ``null``; repeated
    items count once, repeated rows are judged each. An empty benchmark hits nothing,
    an empty table gives no rows. The documents pass once, without a shuffle: each
    task looks the windows of all blocks of the benchmark up.
    """
    blocks = _held(docs.sparkSession, _blocks(benchmark, item_col, item_text))
    source = docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t"))
    schema = "i long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def run(source):
        judge = _Judge(blocks, window)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, hit, items = judge(batch.column(1).to_pylist())
            lists = [",".join(sorted(s)) for s in items]
            return pa.record_batch(
                [
                    batch.column(0), pa.array(words), pa.array(hit), pa.array([len(s) for s in items], pa.int64()),
                    pa.array([sha256(x.encode()).hexdigest() for x in lists]), pa.array(is_contaminated(words, hit)),
                ],
                names=["i", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

        yield from batches(one)(source)

    return source.mapInArrow(run, schema).withColumnRenamed("i", id_col)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, all columns as they are."""
    blocks = _held(docs.sparkSession, _blocks(benchmark, item_col, item_text))

    def run(source):
        judge = _Judge(blocks, window)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            words, hit, _ = judge([None if t is None else t.encode() for t in texts])
            return batch.filter(pa.array(~is_contaminated(words, hit)))

        yield from batches(one)(source)

    return docs.mapInArrow(run, docs.schema)


def _held(spark, blocks) -> list:
    """The blocks as broadcasts, each of a bounded size."""
    return [spark.sparkContext.broadcast(block) for block in blocks]
