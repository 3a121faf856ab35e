"""BPE with word ends: ids of a public tokenizer file, merged in the padded matrices of :mod:`farelane.llm.bpe`."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from farelane.llm.bpe import LETTER, NUMBER, SPACE, Encoder, Vocabulary, contractions, kinds

# Fixed value: the split pattern that this module follows.
KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Marks a code point whose normal form is not a single one, or depends on its neighbours.
ODD = np.uint32(0xFFFFFFFF)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordVocabulary(Vocabulary):
    """Ids and merges of a tokenizer file whose last letter of a word carries an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        model, ids = held["model"], held["model"]["vocab"]
        pattern = [p["pattern"].get("Regex") for p in held["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        if pattern != [KNOWN] or [n["type"] for n in held["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("a tokenizer file with another normalizer or split pattern")
        end = model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.uint64) for k in (0, 1))
        made = np.array([ids[a + b] for a, b in pairs], np.int32)
        if (np.diff(made) <= 0).any():
            raise ValueError("ids of merged tokens don't follow the order of the merges")
        letters = byte_letters()
        self.single = np.array([ids[c] for c in letters], np.int32)
        self.last = np.array([ids[c + end] for c in letters], np.int32)
        self.whole: dict[bytes, int] = {}
        self._table = None
        self._build(left << np.uint64(32) | right, made)

    def letters(self, joined: bytes, count: np.ndarray) -> np.ndarray:
        data = np.frombuffer(joined, np.uint8)
        out = self.single[data]
        stops = np.cumsum(count) - 1
        out[stops] = self.last[data[stops]]
        return out


def _lowered(normalizer, known: np.ndarray) -> np.ndarray:
    """The normal form of each code point that has one of one code point whatever stands beside it, else :data:`ODD`.

    Code points that join or reorder with an earlier one, and unassigned ones, are odd.
    """
    out = np.full(0x110000, ODD)
    assigned = np.flatnonzero(known).tolist()
    joins = {0x1161 + k for k in range(21)} | {0x11A7 + k for k in range(28)}
    for c in assigned:
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            joins.add(int(parts[1], 16))
    alone = [c for c in assigned if not unicodedata.combining(chr(c)) and c not in joins]
    blank = np.flatnonzero(known & (kinds() == SPACE)).tolist()
    out[blank] = blank
    others = np.array(sorted(set(alone) - set(blank)), np.uint32)
    forms = normalizer.normalize_str("\n".join(map(chr, others.tolist()))).split(" ")
    single = np.array([len(f) == 1 for f in forms])
    out[others[single]] = [ord(f) for f, one in zip(forms, single) if one]
    return out


class WordEncoder(Encoder):
    """Encodes texts as the tokenizer file does, without special tokens and without ids for their strings."""

    def __init__(self, path: str, most: int = 1_000_000):
        library = Tokenizer.from_file(path)
        self.normalizer = library.normalizer
        assigned = np.array([unicodedata.category(chr(c)) not in ("Cn", "Cs") for c in range(0x110000)])
        self.kinds = kinds().copy()
        size = lambda text: len(library.pre_tokenizer.pre_tokenize_str(text))
        for c in np.flatnonzero(~assigned & (self.kinds > 0)).tolist():  # new ones: as the library sees them
            x = chr(c)
            self.kinds[c] = LETTER if size(f"a{x}b") == 1 else NUMBER if size(x + x) == 2 else 0
        self.lowered = _lowered(self.normalizer, assigned)
        super().__init__(WordVocabulary(path), KNOWN, most)

    def points(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The code points of the normal forms; texts with odd code points go through the library."""
        raw, count = super().points(texts)
        made = self.lowered[raw]
        odd = np.flatnonzero(made == ODD)
        if not len(odd):
            return made, count
        ends = np.cumsum(count)
        hit = np.unique(np.searchsorted(ends, odd, side="right")).tolist()
        pieces = np.split(made, ends[:-1])
        for k in hit:
            pieces[k] = np.frombuffer(self.normalizer.normalize_str(texts[k]).encode("utf-32-le"), np.uint32)
        return np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))

    def words(self, texts: list[str], points: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words begin and end: letters, one number, or others without white space."""
        mark = np.zeros(len(points), bool)
        mark[first[count > 0]] = True
        kind = self.kinds[points]
        begin = mark.copy()
        begin[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        contractions(begin, points, kind, mark)
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(points))
        use = kind[starts] != SPACE
        return starts[use], ends[use]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One for each Python worker."""
    return WordEncoder(path)
