"""Ranked search against a plain loop over all documents and items."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import rows_of, table
from farelane.llm import lexical


def _words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def _plain(docs, items, most=10):
    held = [(i, Counter(_words(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, words = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(_words(text))
        scored = []
        for i, c, n in held:
            m = 25 + 75 * n * n_docs // words
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, times in asked.items() if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, i, -s) for k, (s, _, i) in enumerate(scored[:most])]
    return sorted(out, key=repr)


def _tables(seed=5):
    rng = random.Random(seed)
    some = ["the", "The", "of", "é", "É", "日本", "x1", "İ"] + [f"w{k}" for k in range(80)]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(some, weights=[40 / (k + 1) for k in range(len(some))], k=n))
    docs = [(k, text(rng.randint(0, 60))) for k in range(150)] + [(300 + k, "the same words") for k in range(25)]
    docs += [(None, "w1 w2 the"), (None, None), (400, ""), (401, "--"), (5, text(9)), (5, "the same words"), (402, text(30_000)), (403, "z" * 4000)]
    items = [(k, text(rng.randint(1, 25))) for k in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "the the THE same"), (7, items[7][1]), (None, items[3][1]), (54, items[3][1] + " " + items[4][1])]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("setting", [{}, {"block_bytes": 200}, {"most": 3}])
def test_search_equals_a_plain_loop(spark, setting):
    docs, items = _tables()
    got = lexical.search(table(spark, docs), table(spark, items, "item_id"), **setting)
    assert rows_of(got) == _plain(docs, items, setting.get("most", 10))


def test_long_texts_are_split_piece_by_piece(monkeypatch):
    text = _tables()[0][-1][1] or "a b"
    text = (text + " ") * 50
    whole = lexical.terms(text.encode())
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert lexical.terms(text.encode()) == whole and sum(whole.values()) == len(_words(text))


def test_items_are_the_sums_of_their_terms():
    items = _tables(6)[1]
    plan = lexical.Plan([lexical.terms((t or "").encode()) for _, t in items])
    leaves = np.random.default_rng(1).integers(0, 100, (len(plan.terms), 5))
    got = plan.scores(leaves)
    for q, (_, text) in enumerate(items):
        want = sum(leaves[_leaf(plan, t, n)] for t, n in lexical.terms((text or "").encode()).items())
        assert (got[q] == want).all()


def _leaf(plan, term, times):
    return next(k for k, t in enumerate(plan.terms) if t == term and plan.times[k] == times)


def test_shared_sets_are_added_once():
    shared = {f"s{k}".encode(): 1 for k in range(20)}
    items = [{**shared, f"own{k}".encode(): 1} for k in range(10)] + [dict(list(shared.items())[:10])] * 3
    plan = lexical.Plan(items)
    additions = len(plan.pairs) + sum(max(0, n - 1) for n in np.diff(plan.bounds))
    assert additions < 0.25 * sum(len(i) for i in items)
    assert max(np.diff(plan.bounds)[:10]) <= 3 and len(plan.layers) <= 19


def test_large_sizes_stay_exact():
    n, tf = np.array([10**10, 3], np.int64), np.array([10**9, 2], np.int64)
    got = lexical._impacts(np.array([1000, 7], np.int64), tf, n, 10**11, 10**13)
    want = [w * (10**9 * int(t) // (1000 * int(t) + 8 * (25 + 75 * int(k) * 10**11 // 10**13))) for w, t, k in zip((1000, 7), tf, n)]
    assert got.tolist() == want


def test_nothing_to_search(spark):
    docs, items = _tables()
    for d, i in (([], items), (docs, []), (docs, [(1, None)]), ([(1, None), (2, "-")], items)):
        assert lexical.search(table(spark, d), table(spark, i, "item_id")).count() == 0
