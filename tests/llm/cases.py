"""Rows that every text operator has to bear, and plain versions of what the operators compute."""

from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import xxhash

#: Extra columns whose names the operators use inside.
CLASHING = ("i", "t", "fp", "u", "v", "c", "node", "root", "bucket", "digest", "least", "key", "size", "label2", "fingerprint")


def passages(seed: int = 3, n: int = 120) -> list[tuple[int | None, str | None]]:
    """Documents with shared passages, copies, runs of one word, nulls, empty and long texts, repeated ids and rows."""
    rng = random.Random(seed)
    words = ["a", "bb", "the", "of", "é", "日本", "x1"] + [f"w{k}" for k in range(60)]
    some = lambda k: [rng.choice(words) for _ in range(k)]
    shared = [some(rng.choice([49, 50, 51, 80, 200])) for _ in range(6)] + [["a"] * 120, ["a", "bb"] * 60]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(n):
        w: list[str] = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.randint(0, 3)
            part = rng.choice(shared)
            w += [some(rng.randint(0, 80)), part, ["a"] * rng.randint(1, 150), part[rng.randint(0, 20) :][: rng.randint(30, 90)]][kind]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    rows += [(500 + k, rows[k][1]) for k in range(15)]
    rows += [(900, None), (901, ""), (902, "x" * 70), (903, "x" * 3000), (904, "\0" * 60 + "é" * 40), (905, " ".join(some(20_000)))]
    rows += [(1, rows[1][1]), (1, rows[2][1]), (7, rows[7][1]), (None, rows[3][1]), (None, None), (None, "only here")]
    rng.shuffle(rows)
    return rows


def table(spark, rows, id_col: str = "doc_id", text_col: str = "text"):
    """The rows with clashing extra columns, over several partitions."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, f"{id_col} long, {text_col} string")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}).repartition(5)


def plain_components(ids: list, linked) -> dict[int, int]:
    """Index -> least index reachable, for positions in ``ids``."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in range(len(ids))}


def plain_fingerprint(text: str | None) -> int:
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_dedup(rows, units, window: int = 50, joiner: bytes = b" ") -> list[tuple]:
    """(id, units, removed, spans, digest of the rest) by looking at every window."""
    first: dict = {}
    cut = lambda u, s: u[s : s + window] if isinstance(u, bytes) else tuple(u[s : s + window])
    every = [(i, units(t or "")) for i, t in rows]
    for i, u in every:
        for s in range(len(u) - window + 1) if i is not None else ():
            k = cut(u, s)
            first[k] = min(first.get(k, i), i)
    out = []
    for i, u in every:
        covered = np.zeros(len(u), bool)
        for s in range(len(u) - window + 1) if i is not None else ():
            if first[cut(u, s)] < i:
                covered[s : s + window] = True
        rest = [u[k] for k in np.flatnonzero(~covered)]
        spans = int((covered[1:] & ~covered[:-1]).sum() + covered[:1].sum())
        data = bytes(rest) if isinstance(u, bytes) else joiner.join(rest)
        out.append((i, len(u), int(covered.sum()), spans, sha256(data).hexdigest()))
    return out


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
