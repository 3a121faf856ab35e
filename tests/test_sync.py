"""Synchronous steps against one process, and fits that go on where a killed one stopped."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farelane.operators.clean import clean_trips
from farelane.operators.features import with_target
from farelane.plans import dense, ledger, sync, train
from farelane.plans.dense import DenseSpec, fit_dense
from farelane.schema import TARGET_COLUMN
from farelane.sources.trips import raw_trips
from farelane.staging import stage

SMALL = DenseSpec(hidden=(8, 4), learning_rate=0.01, batch_size=64)


@pytest.fixture(scope="module")
def sets(spark, folder):
    rows = stage(with_target(clean_trips(raw_trips(spark, folder))), "sync")
    held = F.pmod(F.hash(TARGET_COLUMN), F.lit(4)) == 0
    return rows.filter(~held), rows.filter(held)


def _columns():
    return [f"_{k}" for k in range(66)]


@pytest.mark.parametrize("workers", [1, 3])
def test_tasks_step_like_one_process(spark, sets, workers):
    table, columns, seed = stage(sets[0], "table"), _columns(), 5
    flat = dense.initial_weights(table, columns, SMALL, 1)
    size = len(sync._places(SMALL)[0])
    got, rule, loss = sync._run_pass(table, columns, SMALL, flat, sync.Adam(size, 0.01), workers, seed)

    parts = {}
    for r in sync.dealt(table, columns, workers, seed).withColumn("p", F.spark_partition_id()).collect():
        parts.setdefault(r.p, []).append([r[c] for c in columns])
    per = SMALL.batch_size // workers
    tables = [np.array(parts[p], np.float32) for p in range(workers)]
    adam, want, rows, squared = sync.Adam(size, 0.01), flat, 0, 0.0
    for step in range(max(-(-len(t) // per) for t in tables)):
        mine = [t[step * per : (step + 1) * per] for t in tables]
        told = [sync.part_message(SMALL, want, m[:, :-1], m[:, -1], hash((seed, adam.t, p)) & 0xFFFFFFFF) for p, m in enumerate(mine)]
        want, n, s = sync.combined(SMALL, want, told, adam, sync._keep(adam.t))
        rows, squared = rows + n, squared + s
    assert rows == table.count() and rule.t == adam.t and loss == pytest.approx(squared / rows, rel=1e-6)
    assert np.allclose(got, want, rtol=1e-5, atol=1e-6) and np.allclose(rule.v, adam.v, rtol=1e-4, atol=1e-9)


def test_one_part_is_a_plain_mini_batch():
    rng = np.random.default_rng(1)
    spec = DenseSpec(inputs=5, hidden=(4,), dropout=0.0)
    x, y = rng.normal(size=(40, 5)).astype(np.float32), rng.normal(size=40).astype(np.float32)
    flat = dense._initial(spec, np.zeros(5), np.ones(5), 0.0, 3)
    trained, moments = sync._places(spec)
    told = sync.part_message(spec, flat, x, y, 0)
    layers = dense._split(spec, flat.astype(np.float32))
    squared, grads = dense._step(spec, layers, x, y, np.random.default_rng(0), 0.0)
    full = dense._join([[g[0], g[1], *layer[2:4], g[2], g[3]] for layer, g in zip(layers, grads)])
    assert told[0] == 40 and told[1] == pytest.approx(squared)
    assert np.allclose(told[2 : 2 + len(moments)] / 40, full[moments], atol=1e-6) and np.allclose(told[2 + len(moments) :] / 40, full[trained], atol=1e-5)
    assert not sync.part_message(spec, flat, x[:0], y[:0], 0).any()


def test_synchronous_training_learns(sets):
    rows, held = sets
    model = sync.fit_sync(rows, held, spec=SMALL, epochs=6, workers=2)
    assert model.history[-1]["train_loss"] < model.history[0]["train_loss"]
    assert min(h["val_loss"] for h in model.history) == pytest.approx(dense.losses(held, model)[0], rel=1e-6)


class Killed(RuntimeError):
    pass


@pytest.mark.parametrize("fit", [sync.fit_sync, fit_dense])
def test_a_killed_fit_goes_on(sets, tmp_path, monkeypatch, fit):
    rows, held = sets
    more = {"workers": 2} if fit is sync.fit_sync else {"staging": False}
    whole = fit(rows, held, spec=SMALL, epochs=4, patience=9, ledger=str(tmp_path / "whole"), **more)
    measure, calls = dense.losses, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 3:
            raise Killed
        return measure(*args)

    for module in (dense, sync):
        monkeypatch.setattr(module, "losses", dies)
    with pytest.raises(Killed):
        fit(rows, held, spec=SMALL, epochs=4, patience=9, ledger=str(tmp_path / "cut"), **more)
    for module in (dense, sync):
        monkeypatch.setattr(module, "losses", measure)
    on = fit(rows, held, spec=SMALL, epochs=4, patience=9, ledger=str(tmp_path / "cut"), **more)
    assert [h["epoch"] for h in on.history] == [0, 1, 2, 3]
    assert np.allclose(on.weights, whole.weights, rtol=1e-3, atol=1e-4)
    again = fit(rows, held, spec=SMALL, epochs=4, patience=9, ledger=str(tmp_path / "cut"), **more)  # nothing is left to do
    assert (again.weights == on.weights).all() and again.history == on.history


def test_a_half_written_record_does_not_count(spark, tmp_path):
    path = str(tmp_path)
    assert ledger.last(spark, path) is None
    ledger.record(spark, path, 0, {"a": 1}, {"w": np.array([1.0, 2.0])})
    (tmp_path / "000001").mkdir()
    turn, state, arrays = ledger.last(spark, path)
    assert (turn, state, arrays["w"].tolist()) == (0, {"a": 1}, [1.0, 2.0])


def test_chunks_go_on(sets, tmp_path, monkeypatch):
    rows, held = sets
    chunked = rows.withColumn("chunk_id", F.pmod(F.hash("_23"), F.lit(3)).cast("long"))
    plain, done = train.fit_dense, []

    def dies(part, *args, **kwargs):
        if len(done) == 2:
            raise Killed
        done.append(part.count())
        return plain(part, *args, **kwargs)

    go = lambda: train.fit_chunks(chunked, held, spec=SMALL, epochs=1, ledger=str(tmp_path))
    monkeypatch.setattr(train, "fit_dense", dies)
    with pytest.raises(Killed):
        go()
    done.clear()
    _, lines = go()
    assert len(done) == 1  # only the last chunk was fitted again
    assert [r.chunk_id for r in lines.orderBy("chunk_id").collect()] == [0, 1, 2]
    assert lines.agg(F.sum("rows")).first()[0] == rows.count()


def test_rounds_ahead_are_the_same_rounds(sets):
    rows, held = sets
    alone = stage(rows.coalesce(1), "alone")
    one, more = (fit_dense(alone, held, spec=SMALL, epochs=7, patience=2, staging=False, ahead=n) for n in (1, 4))
    assert [h["epoch"] for h in more.history] == [h["epoch"] for h in one.history]
    for key in ("train_loss", "val_loss", "val_mae"):
        assert [h[key] for h in more.history] == pytest.approx([h[key] for h in one.history], rel=1e-5)
    assert np.allclose(more.weights, one.weights, rtol=1e-5, atol=1e-6)
    spread = fit_dense(rows.repartition(3), held, spec=SMALL, epochs=2, ahead=4)  # several splits are averaged round by round
    assert len(spread.history) == 2
    broken = stage(alone.withColumn("_3", F.when(F.col("_23") > 0.1, F.lit(None)).otherwise(F.col("_3"))), "broken")
    with pytest.raises(ValueError, match=f"^{broken.filter('_3 IS NULL').count()} rows with a missing value"):
        fit_dense(broken, held, warm=one, spec=SMALL, epochs=1, staging=False, ahead=4)


def test_a_chunk_takes_few_jobs(spark, sets):
    rows, held = sets
    chunked = rows.withColumn("chunk_id", F.pmod(F.hash("_23"), F.lit(4)).cast("long"))
    warm = fit_dense(rows, held, spec=SMALL, epochs=1)
    jobs = []
    for chunks in (1, 4):  # what comes before the first chunk is left out
        spark.sparkContext.setJobGroup(f"chunks-{chunks}", "")
        train.fit_chunks(chunked.filter(F.col("chunk_id") < chunks), held, warm=warm, epochs=4, patience=9)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"chunks-{chunks}")))
    spark.sparkContext._jsc.clearJobGroup()
    assert (jobs[1] - jobs[0]) / 3 <= 3  # one trains four rounds, one validates them; 18.7 before


def _rows(n, width, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    return np.column_stack([x, 2 * x[:, 0] + rng.normal(size=n).astype(np.float32)])


@pytest.mark.parametrize("dropout", [0.0, 0.2])
def test_a_part_on_disk_gives_the_sums_of_the_part(monkeypatch, dropout):
    monkeypatch.setattr(sync, "BLOCK", 300)
    spec = DenseSpec(inputs=6, hidden=(9, 5), dropout=dropout, l1=0.01)
    rows = _rows(1000, 6)
    flat = dense._initial(spec, np.zeros(6), np.ones(6), 0.5, 3)
    cut = list(pa.RecordBatch.from_arrays([pa.array(c) for c in t.T], names=list("abcdefg")) for t in (rows[:700], rows[700:]))
    got = [(p.rows, sync.spooled_message(spec, flat, p, 9)) for p in sync._parts(iter(cut), 800)]
    assert [n for n, _ in got] == [800, 200]
    for (n, told), table in zip(got, (rows[:800], rows[800:])):
        layers = dense._split(spec, flat.astype(np.float32).astype(np.float64))
        for layer in layers:
            layer[2][:] = layer[3][:] = 0.0
        exact = table.astype(np.float64)
        want = sync._message(spec, layers, n, *dense._step(spec, layers, exact[:, :-1], exact[:, -1], np.random.default_rng(9), 0.0))
        assert told[0] == n and np.allclose(told / n, want / n, rtol=1e-4, atol=1e-5)


def test_memory_of_a_step_does_not_grow_with_the_part():
    spec, peaks = DenseSpec(inputs=20, hidden=(40, 20)), []
    flat = dense._initial(spec, np.zeros(20), np.ones(20), 0.5, 3)
    names = [str(k) for k in range(21)]
    for n in (30_000, 120_000):
        batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in _rows(10_000, 20, k).T], names=names) for k in range(n // 10_000))
        cut = (sync._mini_batches if n <= sync.BLOCK else sync._parts)(batches, n)
        tracemalloc.start()
        _, rows, _ = sync.one_pass(spec, flat, sync.Adam(len(sync._places(spec)[0]), 0.01), cut, 0, 5, lambda told: [told])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert rows == n
    assert peaks[1] < 1.2 * peaks[0]


def test_tasks_step_alike_on_parts_on_disk(spark, sets):
    spec = DenseSpec(hidden=(8, 4), learning_rate=0.01, batch_size=4 * sync.BLOCK)
    table, columns = stage(sets[0], "table"), _columns()
    flat = dense.initial_weights(table, columns, spec, 1)
    got, rule, loss = sync._run_pass(table, columns, spec, flat, sync.Adam(len(sync._places(spec)[0]), 0.01), 2, 5)
    parts = {0: [], 1: []}
    for r in sync.dealt(table, columns, 2, 5).withColumn("p", F.spark_partition_id()).collect():
        parts[r.p].append([r[c] for c in columns])
    tables = [np.array(parts[p], np.float32) for p in (0, 1)]
    told = [sync.part_message(spec, flat, t[:, :-1], t[:, -1], hash((5, 0, p)) & 0xFFFFFFFF) for p, t in enumerate(tables)]
    _, n, squared = sync.combined(spec, flat, told, sync.Adam(len(rule.m), 0.01), sync._keep(0))
    assert rule.t == 1 and loss == pytest.approx(squared / n, rel=1e-5)
    moments = sync._places(spec)[1]
    sums = sum(told)
    assert np.allclose(got[moments], flat[moments] + (sums[2 : 2 + len(moments)] / n - flat[moments]) * (1 - sync._keep(0)), rtol=1e-4, atol=1e-4)
    assert np.allclose(rule.m, 0.1 * sums[2 + len(moments) :] / n, rtol=1e-3, atol=1e-4)
