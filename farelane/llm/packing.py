"""Best-fit packing of tokenized documents: combinations that fill gaps exactly first, then the best fit.

Pieces are packed by their lengths alone. The lengths' counts are a table of at most
``capacity`` rows, whatever the documents number; from it the driver makes patterns, each
used many times over, and tasks give every piece its place from its rank among the pieces
of its length.
"""

from __future__ import annotations

from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelane.llm import wordbpe
from farelane.llm.shared import batches, utf8
from farelane.staging import stage


class Complements:
    """Available lengths with counts, and an index of the sums that two of them make.

    ``pairs[s]`` numbers the available lengths a with an available s - a, so a gap is
    looked up as a single, as a pair sum, or as a pair sum beside every third length.
    """

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64).copy()
        self.open = self.counts > 0
        self.open[:1] = False
        self.pairs = np.zeros(len(counts), np.int64)
        for a in np.flatnonzero(self.open):
            self._count(a, 1)
            self.pairs[2 * a : 2 * a + 1] -= 1  # met from both sides
        self.pairs //= 2
        for a in np.flatnonzero(self.open):
            self.pairs[2 * a : 2 * a + 1] += 1

    def _count(self, a: int, step: int) -> None:
        others = np.flatnonzero(self.open[: max(len(self.open) - a, 0)])
        self.pairs[others + a] += step

    def take(self, pattern: list[int], times: int) -> None:
        for length, run in groupby(sorted(pattern)):
            self.counts[length] -= times * len(list(run))
            if not self.counts[length] and self.open[length]:
                self._count(length, -1)
                self.open[length] = False

    def _left(self, length: int, used: list[int]) -> bool:
        return self.counts[length] > used.count(length)

    def pair(self, gap: int, used: list[int]) -> list[int] | None:
        """Two lengths that sum to ``gap`` and are still there beside ``used``; of several, those furthest apart."""
        if gap < 2 or self.pairs[gap] <= 0:
            return None
        low = np.arange(1, gap // 2 + 1)
        for a in low[self.open[low] & self.open[gap - low]].tolist():
            b = gap - a
            if self._left(b, used) and self._left(a, [*used, b]):
                return [b, a]
        return None

    def fill(self, gap: int, used: list[int]) -> list[int] | None:
        """One, two or three lengths that fill ``gap`` exactly."""
        if self._left(gap, used) and gap:
            return [gap]
        two = self.pair(gap, used)
        if two:
            return two
        third = np.flatnonzero(self.open[:gap])
        for c in third[self.pairs[gap - third] > 0][::-1].tolist():
            if self._left(c, used):
                two = self.pair(gap - c, [*used, c])
                if two:
                    return [c, *two]
        return None

    def largest(self, most: int, used: list[int]) -> int | None:
        """The best fit of a gap: the largest length that is still there."""
        for a in np.flatnonzero(self.open[: most + 1])[::-1].tolist():
            if self._left(a, used):
                return a
        return None

    def times(self, pattern: list[int]) -> int:
        return min(int(self.counts[a]) // len(list(run)) for a, run in groupby(sorted(pattern)))


def _fill_all(counts: np.ndarray, exact_first: bool) -> list[tuple[list[int], int]]:
    """Patterns and their numbers; residuals wait for all exact combinations, or only for those of longer pieces."""
    capacity, index, out = len(counts) - 1, Complements(counts), []
    for start in np.flatnonzero(index.open)[::-1].tolist() if exact_first else ():
        while index.counts[start]:
            rest = index.fill(capacity - start, [start]) if start < capacity else []
            if rest is None:
                break
            out.append(([start, *rest], index.times([start, *rest])))
            index.take(*out[-1])
    while (start := index.largest(capacity, [])) is not None:
        pattern, gap = [start], capacity - start
        while gap:
            rest = index.fill(gap, pattern)
            if rest is None:
                one = index.largest(gap, pattern)
                rest = [] if one is None else [one]
                if not rest:
                    break
            pattern += rest
            gap -= sum(rest)
        out.append((pattern, index.times(pattern)))
        index.take(*out[-1])
    return out


def patterns(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences) for pieces whose lengths occur ``counts`` times.

    ``len(counts) - 1`` is the capacity. From the longest length down, a piece joins the one,
    two or three others that fill its gap exactly; while no combination does, the largest
    piece that fits goes in. Best fit comes either after all exact combinations or with each length's turn,
    whichever needs fewer sequences. A pattern is used as often as its scarcest length allows, so
    there are hardly more patterns than lengths.
    """
    return min((_fill_all(counts, first) for first in (False, True)), key=lambda made: sum(times for _, times in made))


class Places:
    """Where the piece of a length with a rank among the pieces of that length goes."""

    def __init__(self, counts: np.ndarray):
        runs, sequence, used = [], 0, np.zeros(len(counts), np.int64)
        for pattern, times in patterns(counts):
            offset = 0
            for length, same in groupby(sorted(pattern, reverse=True)):
                many = len(list(same))
                runs.append((length, used[length], many, sequence, offset))
                used[length] += many * times
                offset += many * length
            sequence += times
        self.sequences = sequence
        self.runs = np.array(sorted(runs), np.int64).reshape(-1, 5)

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of each piece."""
        at = np.empty(len(length), np.int64)
        first = np.searchsorted(self.runs[:, 0], length, side="left")
        for size in np.unique(length).tolist():  # ranks are searched within the runs of one length
            mine = length == size
            a, b = np.searchsorted(self.runs[:, 0], [size, size + 1])
            at[mine] = first[mine] + np.searchsorted(self.runs[a:b, 1], rank[mine], side="right") - 1
        _, start, many, sequence, offset = self.runs[at].T
        ahead = rank - start
        return sequence + ahead // many, offset + ahead % many * length


def _cut_pieces(path: str, capacity: int, end: int, with_ids: bool):
    """Every document's ids and the end mark, cut at ``capacity``, with the rank of each piece among the task's of its length."""

    def run(source):
        encode, seen, part = wordbpe.encoder(path), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            tokens, counts = encode([None if t is None else str(t, "utf-8", "replace") for t in batch.column(1).to_pylist()])
            ids = np.insert(tokens, np.cumsum(counts), end)  # after the last id of each document
            size = counts + 1
            many = -(-size // capacity)
            doc = np.repeat(np.arange(len(size)), many)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * capacity
            length = np.minimum(size[doc] - start, capacity)
            a = (np.cumsum(size) - size)[doc] + start
            raw = ids.astype("<u4").tobytes()
            sums = [crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), (a + length).tolist())]
            order = np.argsort(length, kind="stable")
            rank = np.empty(len(length), np.int64)
            value, first, count = np.unique(length[order], return_index=True, return_counts=True)
            rank[order] = np.arange(len(order)) - np.repeat(first, count) + np.repeat(seen[value], count)
            seen[value] += count
            cols = {
                "i": batch.column(0).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array(sums, pa.int64()), "part": pa.array(np.full(len(doc), part, np.int32)), "own": pa.array(rank),
            }
            if with_ids:
                cols["ids"] = pa.ListArray.from_arrays(pa.array(np.append(a, len(ids)), pa.int32()), pa.array(ids, pa.int32()))
            return pa.record_batch(cols)

        yield from batches(one)(source)

    return run


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` of a written table with columns ``part``, ``length`` and ``own`` (the rank in its part), and ``sequence_id`` and ``offset``.

    Ranks among all pieces of a length add what the earlier parts hold: one count per part
    and length, however often a length occurs. Counts by length, at most ``capacity`` rows, come to the
    driver, and the runs of its plan go to the tasks: at most the number of patterns times
    the square root of twice the capacity.
    """
    held = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    offsets = held.select(F.col("part").alias("p"), F.col("length").alias("l"), before.alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    places = Places(counts)
    ranked = pieces.join(offsets, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")))
    ranked = ranked.withColumn("rank", F.col("own") + F.col("before")).drop("p", "l", "before", "part", "own")

    def run(source):
        for batch in source:
            k = batch.schema.get_field_index("rank")
            sequence, offset = places(batch.column("length").to_numpy(), batch.column(k).to_numpy())
            names = [*batch.schema.names[:k], "sequence_id", "offset"]
            yield pa.record_batch([*batch.columns[:k], pa.array(sequence), pa.array(offset)], names=names)

    kept = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, capacity: int = 4096, end: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``(id_col, piece, start, length, ids_crc32, sequence_id, offset)`` for every piece of every row, with ``ids`` on request.

    A row's ids are those of the tokenizer file at ``path``, without special tokens (their
    strings in a text are ordinary text), and then ``end``; null reads as empty and is the
    end mark alone. Only rows of more than ``capacity`` ids are cut, into pieces of
    ``capacity``. ``ids_crc32`` is of little-endian unsigned 32-bit ids. Sequences are
    filled from offset 0 without gaps. Repeated rows and ids, and null ids, are packed row by row; an
    empty table gives no rows; very long texts are encoded piece by piece.

    The pieces are written once, without texts; a lost task ranks its own pieces again.
    """
    source = docs.select(F.col(id_col).cast("long").alias("i"), utf8(text_col).alias("t"))
    schema = "i long, piece int, start long, length long, ids_crc32 long, part int, own long" + ", ids array<int>" * with_ids
    pieces = stage(source.mapInArrow(_cut_pieces(path, capacity, end, with_ids), schema), "pieces")
    return place(pieces, capacity).withColumnRenamed("i", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the packed sequences themselves, of :func:`pack` with ids; a sequence is at most ``capacity`` long."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
