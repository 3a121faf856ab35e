"""SimHash near-duplicate classes by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from farelane.llm.graph import Forest, components
from farelane.llm.shared import batches, cut, join_classes, utf8

BITS = 64
#: Differing bits of a link.
BUDGET = 2
#: Fingerprints of a group beyond which it is dealt out by more of its bits.
GROUP = 512
#: Node pairs of a trie that are held at once.
FRONTIER = 1 << 17

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """Majority of the bits of the XXH64 (seed 42) of all word shingles, as an unsigned integer.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than
    ``size`` make one shingle; no words (or null) give 0.
    """
    words = (text or b"").lower().split()
    n = len(words) - size + 1
    if not words:
        return 0
    if n < 2:
        shingles = [b" ".join(words)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        shingles = [line[a:b] for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist())]
    n = len(shingles)
    digests = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(42))), np.uint8).reshape(n, 8)
    if n < 64:
        ones = np.unpackbits(digests, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(digests[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _marked(docs: DataFrame, id_col: str, text_col: str, size: int, mark: Column) -> DataFrame:
    """``(i, mark, fp)`` of every row: its id, a number that goes with it, its fingerprint."""
    source = docs.select(F.col(id_col).cast("long").alias("i"), mark.cast("long").alias("mark"), utf8(text_col).alias("t"))
    kind = pa.schema([("i", pa.int64()), ("mark", pa.int64()), ("fp", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.fromiter((fingerprint(t, size) for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], schema=kind)

    return source.mapInArrow(batches(run), "i long, mark long, fp long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id_col, fp)`` of every row, in one pass without a shuffle; ``fp`` is the signed view of the 64 bits."""
    return _marked(docs, id_col, text_col, size, F.lit(0)).select(F.col("i").alias(id_col), "fp")


# ---------------------------------------------------------------- masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _first_masks() -> list[int]:
    """Three blocks of bits: with two differing bits at most, one block is equal."""
    edges = [0, 22, 43, 64]
    return [sum(1 << (63 - b) for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]


def _finer(mask: int) -> list[int]:
    """Of the bits a mask leaves free, four blocks: with two differing bits, two blocks are equal."""
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    step = len(free) / 4
    blocks = [sum(1 << b for b in free[round(k * step) : round((k + 1) * step)]) for k in range(4)]
    return [mask | x | y for x, y in combinations(blocks, 2)]


def mask_levels(depth: int = 3) -> list[list[int]]:
    """Masks by level; those at ``6 k .. 6 k + 5`` refine mask ``k`` of the level before."""
    levels = [_first_masks()]
    while len(levels) < depth:
        levels.append([x for m in levels[-1] for x in _finer(m)])
    return levels


# ---------------------------------------------------------------- trie


def _permuted(values: np.ndarray, mask: int) -> np.ndarray:
    """The bits of the mask first, then the others; the order within each part is kept."""
    order = [b for b in range(63, -1, -1) if mask >> b & 1] + [b for b in range(63, -1, -1) if not mask >> b & 1]
    out = np.zeros_like(values)
    for b in order:
        out = (out << np.uint64(1)) | ((values >> np.uint64(b)) & np.uint64(1))
    return out


def trie_pairs(values: np.ndarray, fixed: int, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sorted distinct words that agree in the first ``fixed`` bits and differ in ``budget`` at most.

    A node of the trie is a range of the sorted words. Node pairs go down together,
    one bit a step, and carry the bits in which they differ; a pair over budget is
    dropped with all that is below it. Two single words are compared at once. At
    most :data:`FRONTIER` pairs are taken a step, depth first.
    """
    if len(values) < 2:
        return
    shift = np.uint64(BITS - fixed)
    top = values >> shift if fixed else np.zeros(len(values), np.uint64)
    lo = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1])))
    hi = np.append(lo[1:], len(values))
    wide = hi - lo > 1
    lo, hi = lo[wide], hi[wide]
    stack = [(fixed, lo, hi, lo, hi, np.zeros(len(lo), np.int8))] if len(lo) else []
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > FRONTIER:
            for s in range(0, len(alo), FRONTIER):
                stack.append((depth, *(x[s : s + FRONTIER] for x in (alo, ahi, blo, bhi, err))))
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            yield i[near], j[near]
            alo, ahi, blo, bhi, err = (x[~single] for x in (alo, ahi, blo, bhi, err))
        if not len(alo) or depth == BITS:
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
        amid = np.searchsorted(values, (values[alo] & above) | bit)
        bmid = np.searchsorted(values, (values[blo] & above) | bit)
        self_ = alo == blo
        parts = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1)]
        other = ~self_
        parts.append((amid[other], ahi[other], blo[other], bmid[other], err[other] + 1))
        joined = [np.concatenate(x) for x in zip(*parts)]
        alo, ahi, blo, bhi, err = joined
        keep = (ahi > alo) & (bhi > blo) & (err <= budget) & ~((alo == blo) & (ahi - alo == 1))
        if keep.any():
            stack.append((depth + 1, *(x[keep] for x in (alo, ahi, blo, bhi, err))))


def _links(levels: list[list[int]]):
    """``mapInArrow`` function: the fingerprints of a partition by mask -> a spanning forest of their links."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(np.asarray(b.column(0)), np.asarray(b.column(1)), np.asarray(b.column(2))) for b in source if b.num_rows]
        if not got:
            return
        level, which, fp = (np.concatenate(x) for x in zip(*got))
        values, at = np.unique(fp.view(np.uint64), return_inverse=True)
        forest = Forest(len(values))
        kinds = level.astype(np.int64) * 1000 + which
        for kind in np.unique(kinds):
            mask = levels[kind // 1000][kind % 1000]
            own = np.unique(at[kinds == kind])
            words = _permuted(values[own], mask)
            order = np.argsort(words)
            for i, j in trie_pairs(words[order], mask.bit_count()):
                forest.add(own[order[i]], own[order[j]])
        i, r = forest.edges()
        signed = values.view(np.int64)
        yield pa.record_batch([pa.array(signed[i]), pa.array(signed[r])], names=["u", "v"])

    return run


def links(prints: DataFrame, group: int = GROUP) -> DataFrame:
    """``prints(fp)``, distinct -> ``(u, v)``: links that connect all fingerprints within :data:`BUDGET` bits.

    Fingerprints meet in groups that agree on a block of bits: two differing bits
    leave one of three blocks equal. A group of more than ``group`` members is dealt
    out again by half of its free bits (six choices of two blocks out of four), and
    once more, so no group holds more than 2**11 of them and none is cut. Each task
    returns a spanning forest, at most one link per fingerprint it has read.
    """
    levels = mask_levels()
    array = lambda k: F.array(*(F.lit(_signed(m)) for m in levels[k]))
    place = lambda df, k: df.withColumn("key", F.col("fp").bitwiseAND(F.element_at(array(k), F.col("which") + 1)))
    now = place(prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("which")), 0)
    done = None
    for k in range(len(levels)):
        final = now
        if k < len(levels) - 1:
            hot = cut(now.groupBy("which", "key").count().filter(F.col("count") > group).select(F.col("which").alias("hw"), F.col("key").alias("hk")))
            if not hot.isEmpty():
                same = (F.col("which") == F.col("hw")) & (F.col("key") == F.col("hk"))
                final = now.join(hot, same, "left_anti")
                more = now.join(hot, same, "left_semi")
                now = place(more.select("fp", F.explode(F.sequence(F.col("which") * 6, F.col("which") * 6 + 5)).alias("which")), k + 1)
        dealt = final.select(F.lit(k).alias("level"), F.col("which").cast("int").alias("which"), "fp", "key")
        done = dealt if done is None else done.unionByName(dealt)
        if final is now:
            break
    return done.repartition("level", "which", "key").select("level", "which", "fp").mapInArrow(_links(levels), "u long, v long")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id_col, fingerprint, component_id)`` of every row.

    Two rows link when their fingerprints differ in :data:`BUDGET` bits at most;
    ``component_id`` is the smallest id reachable. Null and empty texts have
    fingerprint 0 and link like any other; repeated rows keep one row each; a null id
    never names a class (a class of null ids only has a null ``component_id``); an
    empty table gives no rows.
    """
    rows = cut(fingerprints(docs, id_col, text_col, size).select(F.col(id_col).alias("i"), "fp"))
    return join_classes(rows, _named(rows), "fp", "n", {"component_id": "component_id"}).select(
        F.col("i").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _named(rows: DataFrame) -> DataFrame:
    """``rows(i, fp)`` -> ``(fp, n, root, component_id)``: the class of each fingerprint, and its smallest id; n rows have the fingerprint.

    Ids may repeat, so two classes can have one smallest id; ``root`` tells them apart.
    """
    prints = rows.groupBy("fp").agg(F.min("i").alias("least"), F.count("*").alias("n"))
    found = components(links(prints.select("fp")))
    by_print = cut(prints.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    by_root = by_print.groupBy("root").agg(F.min("least").alias("least"), F.count("*").alias("n"))
    return join_classes(by_print, by_root, "root", "n", {"least": "component_id"}).select("fp", "n", "root", "component_id")


def surplus(docs: DataFrame, mark: Column, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(i, mark, first)``: what is too much if each class of :func:`near_classes` keeps one of its rows with an id.

    ``mark`` is a hash of the whole row. A class keeps the least mark of its smallest
    id; the ids and marks of its other rows are listed once each, with ``first`` false.
    Equal rows that are the least of their class are listed with ``first`` true: one of
    them stays. Rows without an id are not listed.
    """
    rows = cut(_marked(docs, id_col, text_col, size, mark))
    named = join_classes(rows, _named(rows.select("i", "fp")), "fp", "n", {"root": "root", "component_id": "component_id"}).filter("i IS NOT NULL")
    each = cut(named.groupBy("root", "component_id", "i", "mark").agg(F.count("*").alias("n")))
    least = each.groupBy("root").agg(F.min(F.when(F.col("i") == F.col("component_id"), F.col("mark"))).alias("least"), F.count("*").alias("size"))
    judged = join_classes(each, least, "root", "size", {"least": "least"})
    first = (F.col("i") == F.col("component_id")) & (F.col("mark") == F.col("least"))
    return judged.select("i", "mark", first.alias("first"), "n").filter("NOT first OR n > 1").select("i", "mark", "first")
