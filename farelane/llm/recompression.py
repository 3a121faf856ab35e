"""Substring dedup of words by recompression: runs and pairs of symbols get names, round by round."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from farelane.llm.repeats import WINDOW, Rolling, earlier_passages, mixed, ranges

#: Rounds of naming; each names the runs, then the pairs, of the round before.
ROUNDS = 4
_RUN, _LEFT, _RIGHT, _COIN = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


class Level:
    """Symbols of a round: names, and the word at which each begins."""

    def __init__(self, name: np.ndarray, start: np.ndarray):
        self.name, self.start = name, start


def name_runs(level: Level) -> tuple[Level, np.ndarray]:
    """Maximal runs of equal symbols become one symbol named by (symbol, length); also the new place of each symbol."""
    name = level.name
    head = np.concatenate(([True], name[1:] != name[:-1]))
    at = np.flatnonzero(head)
    size = np.diff(np.append(at, len(name))).astype(np.uint64)
    made = np.where(size > 1, mixed(name[at] * _RUN + size), name[at])
    return Level(made, level.start[at]), np.cumsum(head) - 1


def coins(name: np.ndarray, turn: int) -> np.ndarray:
    """Half of all symbols, the same everywhere, may only stand on the right of a pair."""
    return (mixed(name + _COIN * np.full(1, turn + 1, np.uint64)) >> np.uint64(40) & np.uint64(1)).astype(bool)


def name_pairs(level: Level, right: np.ndarray) -> tuple[Level, np.ndarray]:
    """Every left symbol and a right one behind it become one symbol; also the new place of each symbol."""
    name = level.name
    second = np.concatenate(([False], ~right[:-1] & right[1:]))
    first = np.append(second[1:], False)
    at = np.flatnonzero(~second)
    follow = np.minimum(at + 1, len(name) - 1)
    made = np.where(first[at], mixed(name[at] * _LEFT + mixed(name[follow] + _RIGHT)), name[at])
    return Level(made, level.start[at]), np.cumsum(~second) - 1


class _Least:
    """Least entry of any range, by a table of powers of two."""

    def __init__(self, keys: np.ndarray, longest: int):
        self.rows = [keys]
        step = 1
        while 2 * step <= longest:
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]) if len(last) > step else last[:0])
            step *= 2

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        power = np.frexp((hi - lo).astype(float))[1] - 1
        out = np.empty(len(lo), np.uint64)
        for k in np.unique(power):
            at = power == k
            out[at] = np.minimum(self.rows[k][lo[at]], self.rows[k][hi[at] - (1 << int(k))])
        return out


class Words:
    """Documents as words. Every task gives the same run or pair the same name, so no names are sent about."""

    dtype = np.uint64

    def __init__(self, most: int = 400_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __reduce__(self):
        return Words, (self.most,)

    def units(self, text: bytes | None) -> np.ndarray:
        """64-bit hashes of the runs without ASCII white space; the memory of words changes no result."""
        words = (text or b"").split()
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for w in {*words}.difference(known):
            known[w] = xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def values(self, units: np.ndarray) -> np.ndarray:
        return units

    def anchors(self, units: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each window's anchor: the least symbol of its highest round that has a certain one.

        What stands outside a window can only change the symbols at its ends: a run at
        an end may go on outside, a right symbol at the left end may join one outside,
        and a left symbol at the right end, too. These are left out in each round; all
        further in is named alike wherever the window stands. A window without a
        certain symbol keeps to its round before, at last to its words.
        """
        n = len(units) - WINDOW + 1
        lo, hi = np.arange(n), np.arange(n) + WINDOW
        level = Level(units, np.arange(len(units)))
        place, key = np.zeros(n, np.int64), np.zeros(n, np.uint64)
        live = np.arange(n)
        for turn in range(ROUNDS):
            runs, at = name_runs(level)
            low, high = at[lo] + 1, at[hi - 1]
            right = coins(runs.name, turn)
            open_ = low < high
            low = low + right[np.minimum(low, len(right) - 1)]
            high = high - ~right[np.maximum(high - 1, 0)]
            open_ &= low < high
            self._choose(level, turn, lo[~open_], hi[~open_], live[~open_], place, key)
            live, low, high = live[open_], low[open_], high[open_]
            level, at = name_pairs(runs, right)
            lo, hi = at[low], at[high - 1] + 1
        self._choose(level, ROUNDS, lo, hi, live, place, key)
        return place, key

    @staticmethod
    def _choose(level: Level, turn: int, lo: np.ndarray, hi: np.ndarray, live: np.ndarray, place: np.ndarray, key: np.ndarray) -> None:
        if not len(live):
            return
        names = mixed(level.name + np.uint64(turn))
        low_bits = np.uint64((1 << 20) - 1)
        least = _Least((names & ~low_bits) | np.arange(len(names), dtype=np.uint64), WINDOW)(lo, hi)
        at = (least & low_bits).astype(np.int64)
        place[live], key[live] = level.start[at], names[at]

    def weight(self, size: np.ndarray) -> np.ndarray:
        return np.maximum(size - WINDOW + 1, 0)

    def body(self, units: np.ndarray, values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        n = size - WINDOW + 1
        begin = ranges(start, n)
        return Rolling(values)(begin, np.full(len(begin), WINDOW))

    def origins(self, body: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        windows = size - WINDOW + 1
        _, back = np.unique(body, return_inverse=True)
        least = np.full(int(back.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, back, np.repeat(first, windows))
        return least[back]

    def kept(self, text: bytes | None, units: np.ndarray, covered: np.ndarray) -> str:
        words = (text or b"").split()
        if covered.any():
            words = [words[k] for k in np.flatnonzero(~covered).tolist()]
        return sha256(b" ".join(words)).hexdigest()


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_removed, n_spans, kept_sha256)`` of every row.

    A word is removed when 50 consecutive words that cover it also start in a document
    with a smaller id; all is judged on the input. Null and empty texts have no words.
    Rows with one id don't precede each other; a row without an id precedes nothing and
    keeps its words. An empty table gives no rows.

    Recompression gives the inside of equal passages equal symbols. Passages around a
    high symbol that other texts hold as well are compared by the fingerprints of their
    windows (64 bits, next to 56 bits of the symbol).
    """
    found = earlier_passages(docs, Words(), sha256(b"").hexdigest(), id_col, text_col)
    return found.select(id_col, F.col("n").alias("n_words"), "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))
