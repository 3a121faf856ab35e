"""Byte-level BPE over padded matrices: encoding and decoding with a public rank file."""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.shared import batches

NONE = np.int32(np.iinfo(np.int32).max)
#: Bytes of a word beyond which it is merged alone through a heap: a matrix row takes a round for each merge.
LONG = 1024
#: Characters of a very long text that are encoded at once.
PIECE = 1 << 20


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start .. start + size`` of every range, one range after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Vocabulary:
    """Ranks of byte strings, and a hash table from a pair of tokens to the token of their joined bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.whole = self.rank
        size = max(self.rank.values()) + 1
        self.bytes = [b""] * size
        for word, k in self.rank.items():
            self.bytes[k] = word
        self.length = np.fromiter(map(len, self.bytes), np.int64, size)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        left, right, made = [], [], []
        for word, k in self.rank.items():
            for cut in range(1, len(word)):
                a, b = self.rank.get(word[:cut]), self.rank.get(word[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(k)
        self._table: dict[int, int] | None = None
        self._build(np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64), np.array(made, np.int32))

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Open addressing with linear probing, filled in rounds: in each, the first claimant of a free slot gets it."""
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << bits, NONE, np.int32)
        slot = self._slot(keys)
        self.probes = 0
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.values[slot] == NONE)
            taken, first = np.unique(slot[free], return_index=True)
            got = free[first]
            self.keys[taken], self.values[taken] = keys[got], values[got]
            rest = np.ones(len(keys), bool)
            rest[got] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair merges to, which is also its rank, or :data:`NONE`."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        live = np.flatnonzero((self.keys[slot] != keys) & (self.values[slot] != NONE))
        while len(live):
            slot[live] = (slot[live] + 1) & self.mask
            at = slot[live]
            same = self.keys[at] == keys[live]
            out[live[same]] = self.values[at[same]]
            live = live[~same & (self.values[at] != NONE)]
        return out

    def letters(self, joined: bytes, count: np.ndarray) -> np.ndarray:
        """The tokens of single bytes that words of ``count`` bytes, one after another, begin as."""
        return self.single[np.frombuffer(joined, np.uint8)]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, sizes) of words of about one length, padded to a matrix.

        In each round every row merges its leftmost least pair; rows that have nothing
        to merge leave the matrix, and columns that no row fills are cut off.
        """
        count = np.fromiter(map(len, words), np.int64, len(words))
        width = int(count.max())
        grid = np.zeros((len(words), width), np.int32)
        filled = np.arange(width) < count[:, None]
        grid[filled] = self.letters(b"".join(words), count)
        rank = np.full((len(words), max(width - 1, 1)), NONE, np.int32)
        both = filled[:, 1:]
        rank[:, : width - 1][both] = self.pairs(grid[:, :-1][both], grid[:, 1:][both])
        done, sizes = np.zeros_like(grid), count.copy()
        rows = np.arange(len(words))
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            still = best != NONE
            if not still.all():
                over = rows[~still]
                done[over, : grid.shape[1]] = grid[~still]
                sizes[over] = count[~still]
                rows, grid, rank, count, at, best = rows[still], grid[still], rank[still], count[still], at[still], best[still]
                if not len(rows):
                    break
                width = int(count.max())
                grid, rank = grid[:, :width], rank[:, : max(width - 1, 1)]
            me = np.arange(len(rows))
            cols = np.arange(width)
            tail = cols[:-1] > at[:, None]
            grid[:, :-1][tail] = grid[:, 1:][tail]
            grid[me, at] = best
            tail = cols[: rank.shape[1] - 1] >= at[:, None]
            rank[:, :-1][tail] = rank[:, 1:][tail]
            rank[:, -1] = NONE
            count = count - 1
            for shift in (-1, 0):  # the pairs that the new token is part of
                k = at + shift
                use = (k >= 0) & (k + 1 < count)
                inside = (k >= 0) & (k < rank.shape[1])
                rank[me[inside], k[inside]] = NONE
                rank[me[use], k[use]] = self.pairs(grid[me[use], k[use]], grid[me[use], k[use] + 1])
        return done[np.arange(done.shape[1]) < sizes[:, None]], sizes

    def merged_long(self, word: bytes) -> np.ndarray:
        """Tokens of one long word: its pairs wait in a heap by rank and place, merged tokens leave a linked list.

        Each merge costs a few heap steps however long the word is; the order is that of
        :meth:`merged`, the least rank first and its leftmost place first.
        """
        start = self.letters(word, np.array([len(word)], np.int64))
        first = self.pairs(start[:-1], start[1:])
        live = np.flatnonzero(first != NONE)
        heap = ((first[live].astype(np.int64) << 32) | live).tolist()
        heapq.heapify(heap)
        token, rank, n = start.tolist(), first.tolist(), len(start)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank.append(int(NONE))
        table, none = self.table(), int(NONE)
        while heap:
            best = heapq.heappop(heap)
            k, best = best & 0xFFFFFFFF, best >> 32
            if rank[k] != best:
                continue  # this pair is gone
            gone = after[k]
            token[k], rank[gone] = best, none
            after[k] = right = after[gone]
            token[gone] = -1
            if right < n:
                before[right] = k
                made = rank[k] = table.get(best << 32 | token[right], none)
                if made != none:
                    heapq.heappush(heap, made << 32 | k)
            else:
                rank[k] = none
            left = before[k]
            if left >= 0:
                made = rank[left] = table.get(token[left] << 32 | best, none)
                if made != none:
                    heapq.heappush(heap, made << 32 | left)
        out = np.array(token, np.int32)
        return out[out >= 0]

    def table(self) -> dict[int, int]:
        """The pairs as a dict, made when the first long word comes."""
        if self._table is None:
            used = np.flatnonzero(self.values != NONE)
            self._table = dict(zip(self.keys[used].tolist(), self.values[used].tolist()))
        return self._table

    def encode_words(self, words: list[bytes], cells: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, sizes) of the words in turn; a word that is a token itself is that token."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        whole = np.fromiter((self.whole.get(w, -1) for w in words), np.int64, len(words))
        order = np.argsort(np.where(whole >= 0, 0, length), kind="stable")
        sizes = np.ones(len(words), np.int64)
        direct = int((whole >= 0).sum())
        parts = [whole[order[:direct]].astype(np.int32)]
        at = direct
        while at < len(order):  # rows of one bucket differ in length by a quarter at most
            w = int(length[order[at]])
            if w > LONG:
                for i in order[at:]:
                    parts.append(self.merged_long(words[i]))
                    sizes[i] = len(parts[-1])
                break
            same = int(np.searchsorted(length[order[direct:]], min(max(w + w // 4, w + 1), LONG), side="right")) + direct
            end = min(same, at + max(1, cells // (w + w // 4 + 1)))
            tokens, own = self.merged([words[i] for i in order[at:end]])
            parts.append(tokens)
            sizes[order[at:end]] = own
            at = end
        flat = np.concatenate(parts)
        made = sizes[order]
        begin = np.empty(len(words), np.int64)
        begin[order] = np.cumsum(made) - made
        return flat[_ranges(begin, sizes)], sizes

    def decode(self, tokens: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered from one table."""
        return self.flat[_ranges(self.start[tokens], self.length[tokens])].tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Built once in each Python worker; the file is not copied into tables or closures."""
    return Vocabulary(path)


# Fixed value: the public split pattern that word_starts follows; any other one is left to the regex library.
KNOWN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LETTER, NUMBER, SPACE = 1, 2, 3


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """The kind of every code point: letter, number, white space or none of them."""
    found = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(name, every):
            found[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    return found


def word_starts(points: np.ndarray, text_start: np.ndarray) -> np.ndarray:
    """Which code points begin a word of :data:`KNOWN`; ``text_start`` marks the first of each text."""
    kind = kinds()[points]
    begin = text_start.copy()
    begin[1:] |= kind[1:] != kind[:-1]
    # white space before other text leaves its last character: a blank joins the next word, others stand alone
    after = np.flatnonzero(begin[1:] & ~text_start[1:] & (kind[:-1] == SPACE)) + 1
    blank = points[after - 1] == 0x20
    begin[after - 1] = True
    begin[after[blank]] = False
    contractions(begin, points, kind, text_start)
    return begin


def contractions(begin: np.ndarray, points: np.ndarray, kind: np.ndarray, text_start: np.ndarray) -> None:
    """An apostrophe alone that begins a word takes one or two letters with it; ``begin`` is changed in place."""
    n = len(points)
    mark = np.flatnonzero((points[:-1] == 0x27) & begin[:-1] & (kind[1:] == LETTER) & ~text_start[1:]) if n else np.zeros(0, np.int64)
    one = np.isin(points[mark + 1], [ord(c) for c in "stmd"])
    third = np.minimum(mark + 2, n - 1)
    inside = (mark + 2 < n) & ~text_start[third]
    two = np.zeros(len(mark), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (points[mark + 1] == ord(a)) & (points[third] == ord(b)) & inside
    for chosen, size in ((mark[one], 2), (mark[two], 3)):
        begin[chosen + 1] = False
        ends = chosen + size
        begin[ends[ends < n]] = True


def cuts(text: str, most: int | None = None):
    """Pieces of about ``most`` characters that begin with a blank after another character, where no word runs on."""
    most, start = most or PIECE, 0
    while start < len(text):
        end = text.find(" ", start + most)
        while end > 0 and text[end - 1].isspace():
            end = text.find(" ", end + 1)
        end = end if end > 0 else len(text)
        yield text[start:end]
        start = end


_POWER = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (_POWER, pow(_POWER, -1, 1 << 64)):
        steps = np.full(size, np.uint64(b))
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _prints(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of ranges of code points, equal for equal ranges wherever they stand.

    Different ranges can share one (Thue-Morse words do, whatever the base), so they only group.
    """
    up, down = _powers(max(1 << 21, 1 << len(points).bit_length()))
    value = (points.astype(np.uint64) + np.uint64(0x51)) * np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * up[: len(points)], dtype=np.uint64)))
    return (total[ends] - total[starts]) * down[starts]


def _unlike(a: np.ndarray, a_start: np.ndarray, b: np.ndarray, b_start: np.ndarray, a_size: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """Which ranges of ``a`` differ from their ranges of ``b``, code point by code point."""
    out = a_size != b_size
    size = np.where(out, 0, a_size)
    wrong = np.flatnonzero(a[_ranges(a_start, size)] != b[_ranges(b_start, size)])
    if len(wrong):
        out[np.searchsorted(np.cumsum(size), wrong, side="right")] = True
    return out


class Encoder:
    """Encodes texts; remembers the tokens of words, and forgets them all when it holds too many.

    A word is known by its code points: fingerprints group equal words, and each word
    is compared with the first of its group and with the remembered one.
    """

    def __init__(self, vocab: Vocabulary, pattern: str, most: int = 1_000_000):
        self.vocab, self.most = vocab, most
        self.split = None if pattern == KNOWN else regex.compile(pattern).finditer
        self._clear()

    def _clear(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.start, self.size = _Store(np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.text, self.text_start, self.text_size = _Store(np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def points(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The code points of all texts one after another, and how many each text has."""
        count = np.fromiter(map(len, texts), np.int64, len(texts))
        return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), count

    def words(self, texts: list[str], points: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of all texts begin and end."""
        if self.split is None:
            mark = np.zeros(len(points), bool)
            mark[first[count > 0]] = True
            starts = np.flatnonzero(word_starts(points, mark))
            return starts, np.append(starts[1:], len(points))
        spans = [(m.start() + f, m.end() + f) for t, f in zip(texts, first.tolist()) for m in self.split(t)]
        at = np.array(spans, np.int64).reshape(-1, 2)
        return at[:, 0], at[:, 1]

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all texts one after another, number of tokens of each text)."""
        texts = [t or "" for t in texts]
        if len(texts) == 1 and len(texts[0]) > 2 * PIECE:
            pieces = list(cuts(texts[0]))
            if len(pieces) > 1:
                parts = [self([p])[0] for p in pieces]
                return np.concatenate(parts), np.array([sum(map(len, parts))], np.int64)
        points, count = self.points(texts)
        first = np.cumsum(count) - count
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts, ends = self.words(texts, points, first, count)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        mine = _prints(points, starts, ends)
        _, one, back = np.unique(mine, return_index=True, return_inverse=True)
        length = ends - starts
        other = _unlike(points, starts, points, starts[one][back], length, length[one][back])
        while other.any():  # a fingerprint names several words: the first of those left begins a group of its own
            rest = np.flatnonzero(other)
            _, lead, again = np.unique(mine[rest], return_index=True, return_inverse=True)
            back[rest], one = len(one) + again, np.concatenate((one, rest[lead]))
            other[rest] = _unlike(points, starts[rest], points, starts[one][back[rest]], length[rest], length[one][back[rest]])
        place = self._look(points, starts[one], ends[one], mine[one])
        ids = place[back]
        size = self.size[ids]
        tokens = self.flat.held()[_ranges(self.start[ids], size)]
        total = np.concatenate(([0], np.cumsum(size)))
        at = np.searchsorted(starts, first)
        return tokens, np.diff(np.append(total[at], total[-1]))

    def _look(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, mine: np.ndarray) -> np.ndarray:
        """Places of distinct words in the memory; unknown ones are encoded and added."""
        if len(self.size) > self.most or self.text.used > 16 * self.most:
            self._clear()
        length = ends - starts
        place = np.full(len(mine), -1, np.int64)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, mine), len(self.known) - 1)
            have = np.flatnonzero(self.known[at] == mine)
            found = self.place[at[have]]
            same = ~_unlike(points, starts[have], self.text.held(), self.text_start[found], length[have], self.text_size[found])
            place[have[same]] = found[same]
        new = np.flatnonzero(place < 0)
        if not len(new):
            return place
        line = points[_ranges(starts[new], length[new])].tobytes().decode("utf-32-le")
        stops = np.cumsum(length[new]).tolist()
        made, sizes = self.vocab.encode_words([line[a:b].encode() for a, b in zip([0, *stops[:-1]], stops)])
        place[new] = np.arange(len(self.size), len(self.size) + len(new))
        self.start = np.concatenate((self.start, self.flat.used + np.cumsum(sizes) - sizes))
        self.size = np.concatenate((self.size, sizes))
        self.flat.add(made)
        self.text_start = np.concatenate((self.text_start, self.text.used + np.cumsum(length[new]) - length[new]))
        self.text_size = np.concatenate((self.text_size, length[new]))
        self.text.add(points[_ranges(starts[new], length[new])])
        # of words with one fingerprint the first is remembered, the others are encoded whenever they come
        fresh, lead = np.unique(mine[new], return_index=True)
        at = np.searchsorted(self.known, fresh)
        if len(self.known):
            unseen = self.known[np.minimum(at, len(self.known) - 1)] != fresh
            fresh, lead, at = fresh[unseen], lead[unseen], at[unseen]
        self.known, self.place = np.insert(self.known, at, fresh), np.insert(self.place, at, place[new[lead]])
        return place


class _Store:
    """A growing array."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> None:
        if self.used + len(more) > len(self.values):
            room = np.zeros(2 * (self.used + len(more)), self.values.dtype)
            room[: self.used] = self.values[: self.used]
            self.values = room
        self.values[self.used : self.used + len(more)] = more
        self.used += len(more)

    def held(self) -> np.ndarray:
        return self.values[: self.used]


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, so that its memory of words serves all its tasks."""
    return Encoder(vocabulary(path), pattern)


def tokenize(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of every row, with ``ids`` on request; one pass.

    Every match of ``pattern`` is encoded by itself, without special tokens; the ids
    are decoded again and both are digested (ids as little-endian unsigned 32-bit
    integers). Null reads as empty: no tokens, digests of nothing. Repeated rows are
    encoded alike; an empty table gives no rows. A word of over :data:`LONG` bytes is
    merged alone through a heap, some seconds a megabyte; very long texts are encoded piece by piece.
    """
    source = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    schema = "i long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(source):
        encode = encoder(path, pattern)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            tokens, counts = encode(batch.column(1).to_pylist())
            raw, ends = tokens.astype("<u4").tobytes(), np.cumsum(counts).tolist()
            vocab = encode.vocab
            size = np.concatenate(([0], np.cumsum(vocab.length[tokens])))
            text = vocab.decode(tokens)
            starts = [0, *ends[:-1]]
            cols = [
                batch.column(0), pa.array(counts),
                pa.array([sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(starts, ends)]),
                pa.array([sha256(text[size[a] : size[b]]).hexdigest() for a, b in zip(starts, ends)]),
            ]
            names = ["i", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(tokens, pa.int32())))
                names.append("ids")
            return pa.record_batch(cols, names=names)

        yield from batches(one)(source)

    return source.mapInArrow(run, schema).withColumnRenamed("i", id_col)
