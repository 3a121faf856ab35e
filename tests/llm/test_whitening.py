"""Whitening against exact sums and a plain eigen-decomposition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import CLASHING
from farelane.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def _rows(n=150, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dim, dim)) * np.linspace(0.2, 2, dim)
    rows = [(k, [float(np.float32(c)) for c in rng.normal(size=dim) @ mix], 1) for k in range(n)]
    rows += [(k, rows[0][1], None) for k in range(500, 540)]  # copies, a repeated id and row, a null id
    rows += [(3, rows[5][1], 2), (3, rows[3][1], 1), (None, rows[7][1], 1)]
    bad = [None, [], [float("nan")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [float("-inf")] * dim, [1.0] * (dim - 1)]
    return rows, rows + [(900 + k, v, 1) for k, v in enumerate(bad)]


def _plain(rows):
    x = np.array([[int(np.floor(64.0 * c)) + 1_000_000 for c in v] for _, v, _ in rows], object)
    n, s = len(x), x.sum(axis=0)
    t = n * x - s
    centred = t.astype(float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return n, (t * t).sum(axis=1), centred, e[::-1], u[:, ::-1]


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in CLASHING}).repartition(5)


def _check(got, rows, count):
    n, deviation, centred, e, u = _plain(rows)
    assert len(got) == len(rows) * count
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9
    by: dict = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    wanted: dict = {}
    for k, (i, _, _) in enumerate(rows):
        wanted.setdefault((i, int(deviation[k])), []).append(k)
    assert {k: len(v) for k, v in by.items()} == {k: len(v) * count for k, v in wanted.items()}
    for c in range(1, count + 1):
        want = centred @ u[:, c - 1] / np.sqrt(e[c - 1])
        one = [r for r in got if r.component == c]
        assert all(abs(r.explained - e[c - 1] / e.sum()) < 1e-9 for r in one)
        plain = sorted((str(i), int(d), float(w)) for (i, _, _), d, w in zip(rows, deviation, want))
        mine = sorted((str(r.vec_id), r.deviation, r.whitened) for r in one)
        flipped = sorted((str(r.vec_id), r.deviation, -r.whitened) for r in one)
        off = [max(abs(a[2] - b[2]) for a, b in zip(plain, side)) for side in (mine, flipped)]
        assert min(off) < 1e-8


@pytest.mark.parametrize("setting", [{}, {"block_bytes": 800, "columns": 5}, {"block_bytes": 800, "slab": 7}])
def test_whitened_rows_equal_a_plain_version(spark, setting):
    good, every = _rows()
    got = whitening.whiten(_frame(spark, every), count=8, **setting).collect()
    _check(got, good, 8)


def test_covariance_of_whitened_rows(spark):
    good, every = _rows(seed=9)
    got = whitening.whiten(_frame(spark, every), count=32).collect()  # fewer dimensions than components
    assert {r.component for r in got} == set(range(1, 13))
    table = np.array([[r.whitened for r in sorted(got, key=lambda r: (str(r.vec_id), r.deviation)) if r.component == c] for c in range(1, 13)])
    table -= table.mean(axis=1)[:, None]
    assert np.abs(table @ table.T / table.shape[1] - np.eye(12)).max() < 1e-9


def test_components_without_variance_are_null(spark):
    rows = [(k, [float(k), 2.0 * k, 5.0], 0) for k in range(20)]
    got = whitening.whiten(_frame(spark, rows)).collect()
    assert {r.component: (r.whitened is None) for r in got} == {1: False, 2: True, 3: True}
    assert got[0].identity_error < 1e-9
    alone = whitening.whiten(_frame(spark, [(1, [1.0, 2.0], 0)])).collect()
    assert [(r.n, r.deviation, r.whitened, r.identity_error) for r in alone] == [(1, 0, None, None)] * 2


def test_large_entries_stay_exact(spark):
    rows = [(k, [float(np.float32(1e6 * (k - 3) ** 3)), float(k % 2)], 0) for k in range(8)] + [(9, [3e38, 1.0], 0)]
    got = {r.vec_id: r.deviation for r in whitening.whiten(_frame(spark, rows)).collect() if r.component == 1}
    x = [[min(int(np.floor(64.0 * c)), 1 << 43) + 1_000_000 for c in v] for _, v, _ in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {rows[k][0]: sum((len(x) * a - s) ** 2 for a, s in zip(x[k], sums)) for k in range(len(x))}
    assert got == {i: (d if d < 1 << 63 else None) for i, d in want.items()}


def test_no_rows(spark):
    for rows in ([], [(1, None, 1), (2, [], 1)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0
