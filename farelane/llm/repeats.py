"""How documents find out which of their passages begin in an earlier document: two rounds of questions.

Texts are dealt into buckets once. In each round a bucket asks the parts that own
the keys of its passages (each key once, however often it occurs there), and a part
answers every bucket that asked. So a key that a third of all documents hold is one
entry for each bucket, not one for each document, and no group of documents is ever
brought together. Questions and answers travel as packed arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelane.llm.shared import join_classes, pack, partitions

#: Length of a window, in units of the method.
WINDOW = 50
#: Documents that hold an anchor; beyond, its windows are dealt one by one by their own content.
HOT = 1000
#: Entries of passages that are compared together; a group of passages is not cut.
INDEX = 1 << 18
#: Units of text that are looked at together.
SEGMENT = 1 << 16

_MASK = np.uint64(0xFFFFFFFFFFFFFF00)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_NONE = np.zeros(0, np.uint64)


# ---------------------------------------------------------------- arrays


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start .. start + size`` of every range, one range after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[1]
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Fingerprints of any range of a sequence of 64-bit values, equal for equal ranges wherever they stand."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray):
        n = len(values)
        if len(Rolling._up) <= n:
            size = 1 << n.bit_length()
            for name, base in (("_up", int(_ODD[0])), ("_down", pow(int(_ODD[0]), -1, 1 << 64))):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(Rolling, name, np.multiply.accumulate(steps))
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * Rolling._up[:n], dtype=np.uint64)))

    def __call__(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mixed((self.total[start + size] - self.total[start]) * Rolling._down[start] + size.astype(np.uint64) * _ODD[1])


def least_in_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by doubling."""
    out, step = keys, 1
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def member(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which keys are in the sorted ``known``, their places there)."""
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[place] == keys, place


# ---------------------------------------------------------------- what a method provides


class Passages:
    """Pieces of a stretch of text: each holds ``windows`` neighbours that share an anchor."""

    def __init__(self, owner, start, windows, anchor, base):
        #: document, first unit in the stretch, number of windows, anchor, first unit in the document
        self.owner, self.start, self.windows, self.anchor, self.base = owner, start, windows, anchor, base


class Method(Protocol):
    """What differs between bytes and words."""

    #: type of the entries that travel for a passage
    dtype: type

    def units(self, text: bytes | None) -> np.ndarray:
        """The units of a text, one entry each."""

    def values(self, units: np.ndarray) -> np.ndarray:
        """64-bit values whose fingerprints stand for the units."""

    def anchors(self, units: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, key) of the anchor of every window; equal windows have equal keys at equal places of theirs."""

    def weight(self, size: np.ndarray) -> np.ndarray:
        """Entries that travel for passages of so many units."""

    def body(self, units: np.ndarray, values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entries of passages, one after another."""

    def origins(self, body: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """For each window of each passage, the least ``first`` of the passages that hold it."""

    def kept(self, text: bytes | None, units: np.ndarray, covered: np.ndarray) -> str:
        """Digest of what is left."""


def stretches(method: Method, units: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(units, owner, start, offset in its document, length of each part): whole documents or parts of long ones.

    A long document is cut into parts that overlap by a window less one unit, so that
    each window is whole in just one part.
    """
    held, size = [], 0
    for k, u in enumerate(units):
        for at in range(0, max(len(u) - WINDOW + 1, 0), SEGMENT):
            part = u[at : at + SEGMENT + WINDOW - 1]
            if size + len(part) > 2 * SEGMENT and held:
                yield _joined(held)
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple:
    length = np.array([len(p) for _, _, p in held], np.int64)
    return np.concatenate([p for _, _, p in held]), np.array([k for k, _, _ in held], np.int64), np.cumsum(length) - length, np.array([a for _, a, _ in held], np.int64), length


def passages(method: Method, stretch: tuple) -> tuple[np.ndarray, Passages]:
    units, owner, first, offset, length = stretch
    values = method.values(units)
    place, key = method.anchors(units, values)
    window = ranges(first, length - WINDOW + 1)
    part = np.repeat(np.arange(len(owner)), length - WINDOW + 1)
    place, key = place[window], key[window]
    # words around one place can be named in different rounds: then the anchor differs though the place doesn't
    begin = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (key[1:] != key[:-1]) | (part[1:] != part[:-1]))))
    part = part[begin]
    start = window[begin]
    return values, Passages(owner[part], start, np.diff(np.append(begin, len(window))), key[begin], start - first[part] + offset[part])


def split_hot(p: Passages, hot: np.ndarray) -> Passages:
    """The passages of hot anchors, window by window; the others as they are."""
    at = member(p.anchor & _MASK, hot)[0]
    if not at.any():
        return p
    cold, n = ~at, p.windows[at]
    join = lambda x, y: np.concatenate((x[cold], y))
    return Passages(
        join(p.owner, np.repeat(p.owner[at], n)), join(p.start, ranges(p.start[at], n)), join(p.windows, np.ones(int(n.sum()), np.int64)),
        join(p.anchor, np.repeat(p.anchor[at], n)), join(p.base, ranges(p.base[at], n)),
    )


# ---------------------------------------------------------------- rounds


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _dealt(part: np.ndarray, parts: int) -> Iterator[tuple[int, slice, np.ndarray]]:
    """(part, order) for every part that has entries."""
    order = np.argsort(part, kind="stable")
    bound = np.searchsorted(part[order], np.arange(parts + 1))
    for k in np.flatnonzero(np.diff(bound)):
        yield int(k), order[bound[k] : bound[k + 1]]


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((mixed(keys) >> np.uint64(20)) % np.uint64(parts)).astype(np.int64)


ASK = "part int, bucket int, kind int, a binary, b binary, c binary, d binary"
_ASK = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in "abcd")])


def _rows(rows: list[tuple]) -> pa.Table:
    """Rows (part, bucket, kind, up to four arrays) as a table."""
    full = [(*r[:3], *(pack(x) for x in r[3:]), *[b""] * (7 - len(r))) for r in rows]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*full), _ASK)] if full else [pa.array([], f.type) for f in _ASK], schema=_ASK)


def _read(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all entries of a packed column, the row of each)."""
    parts = [np.frombuffer(x, kind) for x in _column(table, name)]
    size = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), np.repeat(np.arange(len(parts)), size)


def _folded(table: pa.Table) -> tuple[list, np.ndarray]:
    """Texts of a bucket, equal ones folded, and the least id of each (none: the largest long)."""
    least: dict[str, list] = {}
    for digest, i, text in zip(_column(table, "digest"), _column(table, "least"), _column(table, "text")):
        i = np.iinfo(np.int64).max if i is None else i
        seen = least.setdefault(digest, [i, text])
        seen[0] = min(seen[0], i)
    keys = sorted(least)
    return [(d, least[d][1]) for d in keys], np.array([least[d][0] for d in keys], np.int64)


def _ask_anchors(method: Method, parts: int):
    """Round one, in a bucket: its anchors, each with the number of texts that hold it (255: or more)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        texts, _ = _folded(table)
        found = []
        for stretch in stretches(method, [method.units(t) for _, t in texts]):
            p = passages(method, stretch)[1]
            found.append(_pairs(p))
        if not found:
            return _rows([])
        keys, count = np.unique(np.concatenate(found), return_counts=True)
        word = keys | np.minimum(count, 255).astype(np.uint64)
        return _rows([(k, key[0].as_py(), 0, word[order]) for k, order in _dealt(_part(keys, parts), parts)])

    return run


def _pairs(p: Passages) -> np.ndarray:
    """The anchors of each text, once for each text."""
    anchor = p.anchor & _MASK
    order = np.lexsort((p.owner, anchor))
    a, o = anchor[order], p.owner[order]
    return a[np.concatenate(([True], (a[1:] != a[:-1]) | (o[1:] != o[:-1])))]


def _meet_anchors(key: tuple, table: pa.Table) -> pa.Table:
    """Round one, in a part: each bucket learns which of its anchors other texts hold, and which are hot."""
    words, row = _read(table, "a", np.uint64)
    buckets = _column(table, "bucket")
    keys, at = np.unique(words & _MASK, return_inverse=True)
    count = np.bincount(at, (words & ~_MASK).astype(float), len(keys)).astype(np.int64)
    out = []
    shared, hot = count >= 2, count > HOT
    bound = np.searchsorted(row, np.arange(len(buckets) + 1))
    for k, bucket in enumerate(buckets):
        own = at[bound[k] : bound[k + 1]]
        use = own[shared[own]]
        if len(use):
            out.append((key[0].as_py(), bucket, 0, keys[use], keys[use[hot[use]]]))
    return _rows(out)


def _shared(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(_read(answers, "a", np.uint64)[0]), np.unique(_read(answers, "b", np.uint64)[0])


def _word(size: np.ndarray, group: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Units of a passage (15 bits), the group it is compared in (16 bits), and whether several texts hold it."""
    return (size.astype(np.uint64) | group << np.uint64(15) | many.astype(np.uint64) << np.uint64(31)).astype(np.uint32)


def _ask_passages(method: Method, parts: int):
    """Round two, in a bucket: the passages whose anchor other texts hold, equal ones once.

    Each comes with its fingerprint, the least document that holds it here (its sign
    bit is set if there are several), and its content.
    """

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        shared, hot = _shared(answers)
        rows = [(bucket % parts, bucket, 1, hot)] if len(hot) else []
        if not len(shared) or not table.num_rows:
            return _rows(rows)
        texts, ids = _folded(table)
        prints, owners, anchors, sizes, bodies, split = [], [], [], [], [], []
        for stretch in stretches(method, [method.units(t) for _, t in texts]):
            values, p = passages(method, stretch)
            use = member(p.anchor & _MASK, shared)[0]
            p = split_hot(Passages(*(x[use] for x in (p.owner, p.start, p.windows, p.anchor, p.base))), hot)
            if not len(p.owner):
                continue
            size = p.windows + WINDOW - 1
            own = Rolling(values)(p.start, size)
            _, one = np.unique(own, return_index=True)
            prints.append(own)
            owners.append(ids[p.owner])
            anchors.append(p.anchor & _MASK)
            first = np.zeros(len(own), bool)
            first[one] = True
            sizes.append(np.where(first, size, 0))
            split.append(member(p.anchor & _MASK, hot)[0])
            bodies.append(method.body(stretch[0], values, p.start[first], size[first]))
        if not prints:
            return _rows(rows)
        own, owner, anchor, size, single = (np.concatenate(x) for x in (prints, owners, anchors, sizes, split))
        body = np.concatenate(bodies)
        place = np.cumsum(method.weight(size)) - method.weight(size)
        unique, back = np.unique(own, return_inverse=True)
        least = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(least, back, owner)
        most = np.full(len(unique), np.iinfo(np.int64).min)
        np.maximum.at(most, back, owner)
        shown = np.flatnonzero(size > 0)
        one = np.zeros(len(unique), np.int64)
        one[back[shown]] = shown
        meet = np.where(single[one], unique, anchor[one])
        part, group = _part(meet, parts), mixed(meet) & np.uint64(0xFFFF)
        for k, order in _dealt(part, parts):
            at = one[order]
            weight = method.weight(size[at])
            rows.append((
                k, bucket, 0, unique[order], least[order], _word(size[at], group[order], most[order] > least[order]),
                body[ranges(place[at], weight)],
            ))
        return _rows(rows)

    return run


def _meet_passages(method: Method):
    """Round two, in a part: for each passage, the runs of its windows and the least document of each run."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        kinds = np.array(_column(table, "kind"))
        rows = [(part, b, 1, np.frombuffer(a, np.uint64)) for b, k, a in zip(_column(table, "bucket"), kinds, _column(table, "a")) if k == 1]
        table = table.filter(pa.array(kinds == 0))
        if not table.num_rows:
            return _rows(rows)
        prints, row = _read(table, "a", np.uint64)
        least, size = _read(table, "b", np.int64)[0], _read(table, "c", np.uint32)[0]
        many, group, size = size >> 31, size >> 15 & 0xFFFF, (size & 0x7FFF).astype(np.int64)
        body = np.frombuffer(b"".join(_column(table, "d")), method.dtype)
        weight = method.weight(size)
        place = np.cumsum(weight) - weight
        unique, one, back = np.unique(prints, return_index=True, return_inverse=True)
        first = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(first, back, least)
        order = np.argsort(group[one], kind="stable")  # equal windows are in one group
        chosen = one[order]
        ends = np.append(np.flatnonzero(np.diff(group[chosen])) + 1, len(chosen))
        total = np.cumsum(weight[chosen])
        origin, done = [], 0
        while done < len(chosen):  # whole groups of about so many entries at a time
            limit = np.searchsorted(total[ends - 1], (total[done - 1] if done else 0) + INDEX, side="right")
            stop = int(ends[max(limit - 1, np.searchsorted(ends, done, side="right"))])
            part_ = chosen[done:stop]
            origin.append(method.origins(body[ranges(place[part_], weight[part_])], size[part_], first[order[done:stop]]))
            done = stop
        origin = np.concatenate(origin)
        windows = size[chosen] - WINDOW + 1
        # runs of windows with one first document
        start = np.cumsum(windows) - windows
        change = np.concatenate(([True], origin[1:] != origin[:-1]))
        change[start] = True
        begin = np.flatnonzero(change)
        n = np.diff(np.append(begin, len(origin)))
        owner = np.searchsorted(start, begin, side="right") - 1
        offset = begin - start[owner]
        runs = np.bincount(owner, minlength=len(chosen))
        run_at = np.cumsum(runs) - runs
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        buckets = _column(table, "bucket")
        bound = np.searchsorted(row, np.arange(len(buckets) + 1))
        for k, bucket in enumerate(buckets):
            mine = slice(bound[k], bound[k + 1])
            c = rank[back[mine]]
            at = ranges(run_at[c], runs[c])
            of = np.repeat(np.arange(len(c)), runs[c])
            # a document that holds the passage alone here learns only of earlier ones
            use = (origin[begin[at]] < least[mine][of]) | (many[mine][of] > 0)
            at, of = at[use], of[use]
            if len(at):
                rows.append((part, bucket, 0, prints[mine][of], origin[begin[at]], offset[at].astype(np.uint16), n[at].astype(np.uint16)))
        return _rows(rows)

    return run


def _finish(method: Method):
    """In a bucket: the units of each text that an earlier document's windows cover."""
    schema = pa.schema([("digest", pa.string()), ("n", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.string()), ("whole", pa.string())])

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, ids = _folded(table)
        kinds = np.array(_column(answers, "kind"))
        hot = np.unique(_read(answers.filter(pa.array(kinds == 1)), "a", np.uint64)[0]) if len(kinds) else _NONE
        told = answers.filter(pa.array(kinds == 0)) if len(kinds) else answers
        prints, origin = _read(told, "a", np.uint64)[0], _read(told, "b", np.int64)[0]
        offset, n = _read(told, "c", np.uint16)[0].astype(np.int64), _read(told, "d", np.uint16)[0].astype(np.int64)
        order = np.argsort(prints, kind="stable")
        prints, origin, offset, n = prints[order], origin[order], offset[order], n[order]
        known, at, runs = np.unique(prints, return_index=True, return_counts=True)
        units = [method.units(t) for _, t in texts]
        change = [np.zeros(len(u) + 1, np.int32) if len(u) >= WINDOW else None for u in units]
        for stretch in stretches(method, units) if len(known) else ():
            values, p = passages(method, stretch)
            p = split_hot(p, hot)
            own = Rolling(values)(p.start, p.windows + WINDOW - 1)
            have, place = member(own, known)
            who = np.flatnonzero(have)
            each = runs[place[who]]
            r, who = ranges(at[place[who]], each), np.repeat(who, each)
            owner = p.owner[who]
            use = origin[r] < ids[owner]
            r, who, owner = r[use], who[use], owner[use]
            begin = p.base[who] + offset[r]
            end = begin + n[r] + WINDOW - 1
            bound = np.searchsorted(owner, np.arange(len(units) + 1)) if (np.diff(owner) >= 0).all() else None
            if bound is None:
                by = np.argsort(owner, kind="stable")
                begin, end = begin[by], end[by]
                bound = np.searchsorted(owner[by], np.arange(len(units) + 1))
            for k in np.flatnonzero(np.diff(bound)):
                np.add.at(change[k], begin[bound[k] : bound[k + 1]], 1)
                np.add.at(change[k], end[bound[k] : bound[k + 1]], -1)
        out = []
        for (digest, text), u, c in zip(texts, units, change):
            covered = np.cumsum(c[:-1]) > 0 if c is not None else np.zeros(len(u), bool)
            removed, spans = int(covered.sum()), int((covered[1:] & ~covered[:-1]).sum() + covered[:1].sum())
            kept = method.kept(text, u, covered)
            whole = method.kept(text, u, np.zeros(len(u), bool)) if removed else kept
            out.append((digest, len(u), removed, spans, kept, whole))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)] if out else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def _fold(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a batch become one with their least id, so that copies are not dealt out."""
    for batch in source:
        if not batch.num_rows:
            continue
        least: dict[str, list] = {}
        for k, (digest, i) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            seen = least.setdefault(digest, [k, i])
            if i is not None and (seen[1] is None or i < seen[1]):
                seen[1] = i
        rows = batch.take(pa.array([k for k, _ in least.values()], pa.int64()))
        yield rows.set_column(2, "least", pa.array([i for _, i in least.values()], pa.int64()))


def earlier_passages(docs: DataFrame, method: Method, empty: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n, n_removed, n_spans, kept)`` of every row of ``docs``.

    A unit is removed when a window of :data:`WINDOW` units that covers it also starts
    in a document with a smaller id, judged on the input. Equal texts are one text with
    the smallest of their ids; the others are covered whole if they hold a window.
    Repeated ids don't precede each other. A row without an id precedes nothing and
    keeps its whole text. ``empty`` is the digest of nothing.

    A task holds one bucket, half a shuffle partition on average: set
    ``spark.sql.shuffle.partitions`` so that a partition is some 100 MB of text at most.
    """
    spark = docs.sparkSession
    p = partitions(spark)
    many = 2 * p  # hashing spreads them over the partitions
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).cast("long").alias("least"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    bucket: Column = F.pmod(F.xxhash64("digest"), F.lit(many)).cast("int")
    texts = base.select(bucket.alias("bucket"), "digest", "least", "text").mapInArrow(_fold, "bucket int, digest string, least long, text binary")
    texts = texts.repartition(p, "bucket")
    asked = texts.groupBy("bucket").applyInArrow(_ask_anchors(method, many), ASK)
    told = asked.repartition(p, "part").groupBy("part").applyInArrow(_meet_anchors, ASK)
    asked = texts.groupBy("bucket").cogroup(told.repartition(p, "bucket").groupBy("bucket")).applyInArrow(_ask_passages(method, many), ASK)
    told = asked.repartition(p, "part").groupBy("part").applyInArrow(_meet_passages(method), ASK)
    done = texts.groupBy("bucket").cogroup(told.repartition(p, "bucket").groupBy("bucket")).applyInArrow(
        _finish(method), "digest string, n long, n_removed long, n_spans long, kept string, whole string"
    )
    least = base.groupBy("digest").agg(F.min("least").alias("first"), F.count("*").alias("size")).withColumnRenamed("digest", "d0")
    classes = done.join(least, F.col("digest") == F.col("d0"))
    names = ("first", "n", "n_removed", "n_spans", "kept", "whole")
    rows = join_classes(base.select(F.col("least").alias("id"), "digest"), classes, "digest", "size", {n: n for n in names})
    none, copy, enough = F.col("id").isNull(), F.col("id") > F.col("first"), F.col("n") >= WINDOW
    pick = lambda lost, own, full: F.when(none, full).when(copy & enough, lost).when(copy, full).otherwise(own)
    return rows.select(
        F.col("id").alias(id_col), "n", pick(F.col("n"), F.col("n_removed"), F.lit(0)).cast("long").alias("n_removed"),
        pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"), pick(F.lit(empty), F.col("kept"), F.col("whole")).alias("kept"),
    )
