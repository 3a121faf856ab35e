"""Suffix-array dedup of bytes with a run-length compressed Burrows-Wheeler transform."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.repeats import WINDOW, earlier_passages, least_in_windows, mixed, ranges

#: Bytes of an anchor, 16 to 24; every window has the least hash of its anchors, the leftmost of equals.
ANCHOR = 24
_PLACE = np.uint64((1 << 20) - 1)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class RunIndex:
    """The transform of a collection of byte strings, stored by runs, with a sample at the end of each run.

    A suffix ends with its string; equal suffixes come in the order of the strings.
    For each run of equal letters only its head is kept: the place in the text, the
    suffix before it in suffix order, and the length of their match. All other places
    follow from the head before them in the text.
    """

    def __init__(self, body: np.ndarray, size: np.ndarray):
        n = int(size.sum()) + len(size)
        start = np.cumsum(size + 1) - size - 1
        self.text = np.zeros(n, np.int16)
        self.text[ranges(start, size)] = body.astype(np.int16) + 1
        #: letters up to the end of the string
        self.left = np.repeat(start + size, size + 1) - np.arange(n)
        order = self._sorted(int(size.max(initial=0)))
        letter = self.text[order - 1]  # place 0 looks at the last end mark
        head = np.concatenate(([True], letter[1:] != letter[:-1])) | (letter == 0)
        at = np.flatnonzero(head)
        self.heads = order[at]
        self.before = np.where(at > 0, order[at - 1], -1)
        self.match = self._compare(self.heads, self.before)

    def _sorted(self, longest: int) -> np.ndarray:
        """Suffix order: as many letters as fit into a word first, then three times (or twice) as many each round."""
        n = len(self.text)
        present = np.zeros(257, np.int64)
        present[self.text] = 1
        present[0] = 0
        letter = (np.cumsum(present) * present).astype(np.uint64)[self.text]
        width = max(1, int(letter.max()).bit_length())
        step = 63 // width
        padded = np.concatenate((letter, np.zeros(step, np.uint64)))
        key = np.zeros(n, np.uint64)
        for k in range(step):
            key = key << np.uint64(width) | np.where(self.left >= k, padded[k : k + n], 0).astype(np.uint64)
        while True:
            last = step > longest
            order = np.argsort(key, kind="stable" if last else None)
            if last:
                return order
            sorted_ = key[order]
            new = np.concatenate(([False], sorted_[1:] != sorted_[:-1]))
            if new[1:].all():
                return order
            rank = np.empty(n + 2 * step, np.uint64)
            rank[n:] = 0
            rank[order] = np.cumsum(new).astype(np.uint64) + np.uint64(1)
            times, bits = (3, 21) if n < 1 << 21 else (2, 32)
            key = rank[:n].copy()
            for k in range(1, times):
                key = key << np.uint64(bits) | np.where(self.left >= k * step, rank[k * step : k * step + n], 0).astype(np.uint64)
            step *= times

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the matches between suffixes; none with a place below 0."""
        size = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        while len(live):
            x, y = self.text[a[live] + size[live]], self.text[b[live] + size[live]]
            live = live[(x == y) & (x > 0)]
            size[live] += 1
        return size

    def matching(self) -> tuple[np.ndarray, np.ndarray]:
        """(length, place) of the match of every suffix with the one before it, streamed along the text.

        Between two heads the match loses one letter a place, and its place moves along.
        """
        n = len(self.text)
        size, before = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        size[self.heads], before[self.heads] = self.match, self.before
        place = np.arange(n)
        last = np.zeros(n, np.int64)
        last[self.heads] = self.heads
        last = np.maximum.accumulate(last)
        return size[last] - (place - last), before[last] + (place - last)


class Bytes:
    """Documents as bytes."""

    dtype = np.uint8

    def units(self, text: bytes | None) -> np.ndarray:
        return np.frombuffer(text or b"", np.uint8)

    def values(self, units: np.ndarray) -> np.ndarray:
        return _BYTE[units]

    def anchors(self, units: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        eight = np.lib.stride_tricks.as_strided(units, (len(units) - 7, 8), (1, 1))
        word = np.ascontiguousarray(eight).view(np.uint64).ravel()
        n = len(units) - ANCHOR + 1
        key = mixed(mixed(mixed(word[:n]) + word[8 : 8 + n]) + word[ANCHOR - 8 : ANCHOR - 8 + n])
        chosen = least_in_windows((key & ~_PLACE) | np.arange(n, dtype=np.uint64), WINDOW - ANCHOR + 1)
        place = (chosen & _PLACE).astype(np.int64)
        return place, key[place]

    def weight(self, size: np.ndarray) -> np.ndarray:
        return size

    def body(self, units: np.ndarray, values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        return units[ranges(start, size)]

    def origins(self, body: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Windows that match for :data:`WINDOW` bytes hang together in suffix order; the least first document wins."""
        index = RunIndex(body, size)
        match, before = index.matching()
        windows = np.flatnonzero(index.left >= WINDOW)
        linked = windows[match[windows] >= WINDOW]
        root = np.arange(len(index.text))
        root[linked] = before[linked]
        while len(linked):
            up = root[root[linked]]
            moved = up != root[linked]
            root[linked] = up
            linked = linked[moved]
        owner = np.repeat(np.arange(len(size)), size + 1)
        least = np.full(len(index.text), np.iinfo(np.int64).max)
        np.minimum.at(least, root[windows], first[owner[windows]])
        return least[root[windows]]

    def kept(self, text: bytes | None, units: np.ndarray, covered: np.ndarray) -> str:
        return sha256(units[~covered].tobytes()).hexdigest()


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_removed, n_spans, kept_sha256)`` of every row.

    A byte of the UTF-8 text is removed when a 50-byte string that covers it also
    starts in a document with a smaller id; all is judged on the input. Null and empty
    texts have no bytes. Rows with one id don't precede each other; a row without an id
    precedes nothing and keeps its text. An empty table gives no rows.

    Passages whose anchor other texts hold are dealt out by it, so all occurrences of a
    string meet in one shard; the shard builds its run-length index and streams the
    matches along its text.
    """
    found = earlier_passages(docs, Bytes(), sha256(b"").hexdigest(), id_col, text_col)
    return found.select(id_col, F.col("n").alias("n_bytes"), "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))
