"""Packing against the tokenizer library and against bounds on the number of sequences."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import table
from farelane.llm import packing, wordbpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def _texts():
    rng = random.Random(8)
    letters = "aAbBcC's tsrevmld'éȨ́ 12½ \n.,-ßİΣ한각ᅡाñ日本😀"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(120)]
    texts += [None, "", " ", "\n\t", "<|endoftext|> x", "Don't 'S 'quoted'ts ''ll", "word " * 4095, "word " * 4096, "word " * 9000, "x" * 5000, "same text"] + ["same text"] * 30
    return texts


def test_ids_equal_the_library(library):
    encode, texts = wordbpe.encoder(PATH), [t or "" for t in _texts()]
    ids, counts = encode(texts)
    assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == library.encode(texts[0], add_special_tokens=False).ids
    at = 0
    for text, n in zip(texts, counts):
        assert ids[at : at + n].tolist() == library.encode(text, add_special_tokens=False).ids, text[:40]
        at += n


def test_every_code_point_equals_the_library(library):
    encode = wordbpe.encoder(PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 7 == 0)]
    for k in range(0, len(points), 5000):
        texts = [f"a{chr(c)}b {chr(c)}" for c in points[k : k + 5000]]
        ids, counts = encode(texts)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


def test_long_texts_piece_by_piece(library, monkeypatch):
    from farelane.llm import bpe

    monkeypatch.setattr(bpe, "PIECE", 50)
    text = " ".join(t for t in _texts() if t)[:30_000]
    ids, counts = wordbpe.encoder(PATH)([text])
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids)]


@pytest.mark.parametrize("capacity", [4096, 64])
def test_pieces_and_places(spark, library, capacity):
    rows = list(enumerate(_texts())) + [(1, "again"), (None, "no id"), (None, None)]
    packed = packing.pack(table(spark, rows), PATH, capacity, with_ids=True)
    got = packed.collect()
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want.append((i, k, a, len(part), crc32(np.array(part, "<u4").tobytes()), part))
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=key) == sorted(want, key=key)
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in got)
    assert -(-total // capacity) <= len(by) <= 1.02 * total / capacity + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert all(whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in got)


def _best_fit(lengths, capacity):
    gaps: list[int] = []
    for x in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= x]
        if fits:
            gaps[gaps.index(min(fits))] -= x
        else:
            gaps.append(capacity - x)
    return len(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_about_as_few_sequences_as_plain_best_fit(seed):
    rng = np.random.default_rng(seed)
    capacity = 200
    kinds = [rng.integers(1, 200, 400), rng.integers(50, 120, 400), rng.choice([1, 66, 67, 100, 101, 33], 400), np.minimum(rng.lognormal(3, 1, 400).astype(int) + 1, 200)]
    for lengths in kinds:
        counts = np.bincount(lengths, minlength=capacity + 1)
        made = packing.patterns(counts)
        used = np.zeros(capacity + 1, int)
        for pattern, times in made:
            assert sum(pattern) <= capacity and times > 0
            np.add.at(used, pattern, times)
        assert (used == counts).all()
        assert sum(times for _, times in made) <= 1.02 * _best_fit(lengths.tolist(), capacity) + 1


def test_plan_does_not_grow_with_the_documents():
    counts = np.random.default_rng(1).integers(0, 50, 201)
    few, many = packing.patterns(counts), packing.patterns(counts * 1_000_000)
    assert len(many) <= 400 and sum(t for _, t in many) <= 1_000_000 * sum(t for _, t in few)


def test_exact_complements_are_found():
    index = packing.Complements(np.bincount([5, 5, 7, 11, 2], minlength=30))
    assert index.fill(11, []) == [11] and index.fill(10, []) == [5, 5] and index.fill(14, [7]) is None
    assert sorted(index.fill(14, [])) == [2, 5, 7] and index.fill(10, [5]) is None and index.fill(29, []) is None
    index.take([5, 5], 1)
    assert index.fill(10, []) is None and index.fill(9, []) == [7, 2]


def test_no_documents(spark):
    assert packing.pack(table(spark, []), PATH).count() == 0
