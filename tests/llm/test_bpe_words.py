"""Words that share a fingerprint, and words too long for a matrix, against the library."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from farelane.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(encoder, library, texts):
    tokens, counts = encoder(texts)
    at = 0
    for text, n in zip(texts, counts):
        assert tokens[at : at + n].tolist() == library.encode_ordinary(text)
        at += n


def thue_morse(rounds: int = 10) -> tuple[str, str]:
    word = "a"
    for _ in range(rounds):
        word = "".join({"a": "ab", "b": "ba"}[c] for c in word)
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_one_fingerprint_keep_their_own_tokens(library):
    a, b = thue_morse()
    points = np.frombuffer((a + b).encode("utf-32-le"), np.uint32)
    prints = bpe._prints(points, np.array([0, 1024]), np.array([1024, 2048]))
    assert prints[0] == prints[1]
    encoder = bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN)
    for texts in ([a, b], [b, a], [f"{a}\n{b}\n{a}", b], ["x", b, "", a]):  # within a batch, then against the memory
        same(encoder, library, texts)


@pytest.mark.parametrize("size", [1023, 1024, 1025, 5000, 300_000])
def test_long_words(library, size):
    rng = random.Random(size)
    encoder = bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN)
    letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))
    mixed = "".join(rng.choice(["the", "ing", "é", "日", "q"]) for _ in range(size))
    same(encoder, library, [letters, "a" * size, "before " + mixed + " after", "=" * size + "\n"])


def test_forgetting_words_changes_nothing(library):
    rng = random.Random(2)
    encoder = bpe.Encoder(bpe.vocabulary(PATH), public_tokenizers.PATTERN, most=20)
    for _ in range(5):
        same(encoder, library, [" ".join("".join(rng.choice("abcé1 ,") for _ in range(6)) for _ in range(50)) for _ in range(4)])
