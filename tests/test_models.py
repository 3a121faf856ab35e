import numpy as np
import pytest
from pyspark.sql import functions as F

from farelane.operators.features import FEATURE_COLUMNS, with_distance
from farelane.operators.clean import clean_trips
from farelane.plans import dense, evaluate, registry, score, train
from farelane.plans.dense import DenseModel, DenseSpec, fit_dense
from farelane.plans.preprocess import preprocess
from farelane.schema import TARGET_COLUMN
from farelane.sources.files import read_processed
from farelane.sources.trips import raw_trips, read_events, requests_from_events

FAST = DenseSpec(learning_rate=0.01, batch_size=32)


@pytest.fixture(scope="module")
def processed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("p") / "rows")
    preprocess(raw_trips(spark, "/root/testdata/sf0.01"), path)
    rows = read_processed(spark, path).repartition(2).cache()
    bucket = evaluate.key_bucket(*FEATURE_COLUMNS)
    return evaluate.split_by_key(rows, bucket)


@pytest.fixture(scope="module")
def naive(processed):
    _, held = processed
    mean = held.agg(F.avg(TARGET_COLUMN)).first()[0]
    return held.agg(F.avg(F.abs(F.col(TARGET_COLUMN) - mean))).first()[0]


def mae(rows, model):
    return evaluate.evaluate(train.predict(rows, model)).first().mae


def test_split_is_stable(processed, spark):
    train_rows, held = processed
    n, k = train_rows.count(), held.count()
    assert 0.25 < k / (n + k) < 0.35
    again = evaluate.split_by_key(train_rows.union(held).repartition(5), evaluate.key_bucket(*FEATURE_COLUMNS))
    assert again[1].count() == k


def test_linear_and_trees_beat_the_mean(processed, naive):
    train_rows, held = processed
    assert mae(held, train.fit(train_rows, "linear")) < naive / 4
    assert mae(held, train.fit(train_rows, "gbt", held, rounds=5)) < naive / 2


def test_gradients(monkeypatch):
    """The backward pass agrees with finite differences."""
    spec = DenseSpec(inputs=4, hidden=(5, 3), penalised=0, dropout=0.0)
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(16, 4)), rng.normal(size=16)
    flat = dense._initial(spec, np.zeros(4), np.ones(4), 0.3, 2)
    flat = flat + rng.normal(scale=0.1, size=flat.size)

    def loss(values):
        squared, grads = dense._step(spec, dense._split(spec, values), x, y, rng, 0.9)
        return squared / len(y), grads

    _, grads = loss(flat)
    zero = [[np.zeros_like(p) for p in layer] for layer in dense._split(spec, flat)]
    for layer, gs in zip(zero, grads):
        for k, g in zip((0, 1, 4, 5), gs):
            layer[k] = g
    analytic = dense._join(zero)
    trained = dense._join([[np.ones_like(p) * (k in (0, 1, 4, 5)) for k, p in enumerate(layer)] for layer in zero])
    for i in np.flatnonzero(trained):
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        assert analytic[i] == pytest.approx((loss(up)[0] - loss(down)[0]) / 2e-5, abs=1e-5)


def test_network_learns_and_continues(processed, naive, spark, tmp_path):
    train_rows, held = processed
    first = fit_dense(train_rows, held, spec=FAST, epochs=4, partitions=2)
    assert min(h["val_mae"] for h in first.history) < naive / 2
    assert mae(held, first) == pytest.approx(min(h["val_mae"] for h in first.history), rel=0.5)
    first.save(str(tmp_path / "m"))
    back = DenseModel.load(spark, str(tmp_path / "m"))
    assert np.array_equal(back.weights, first.weights) and back.spec == first.spec
    second = fit_dense(train_rows, held, warm=back, epochs=2, partitions=2)
    assert min(h["val_loss"] for h in second.history) < 1.5 * min(h["val_loss"] for h in first.history)


@pytest.mark.parametrize("patience, rounds, best", [(1, 3, 1), (2, 8, 5), (3, 9, 5), (0, 3, 1)])
def test_early_stopping_stops_in_the_round_it_should(processed, monkeypatch, patience, rounds, best):
    """A scripted series of validation losses pins the last round and the weights that are kept."""
    script = iter([5.0, 4.0, 4.5, 3.0, 3.5, 2.0, 2.1, 2.2, 2.3, 1.0])
    seen = []

    def scripted(rows, model, target=None):
        seen.append(model.weights)
        return next(script), 0.0

    monkeypatch.setattr(dense, "losses", scripted)
    train_rows, held = processed
    model = fit_dense(train_rows, held, spec=FAST, epochs=10, patience=patience)
    assert len(model.history) == rounds
    assert np.array_equal(model.weights, seen[best])


def test_losses_equal_the_evaluation_of_scored_rows(processed):
    train_rows, held = processed
    model = fit_dense(train_rows, spec=FAST, epochs=1)
    want = evaluate.evaluate(model.transform(held), truth=TARGET_COLUMN).first()
    assert dense.losses(held, model) == pytest.approx((want.loss, want.mae), rel=1e-4)


def test_missing_values_are_not_dropped_in_silence(processed):
    broken = processed[0].withColumn("_3", F.when(F.col("_23") > 0.1, F.lit(None)).otherwise(F.col("_3")))
    with pytest.raises(ValueError, match="missing"):
        fit_dense(broken, spec=FAST, epochs=1)


def test_other_columns_are_left_alone(processed):
    train_rows, held = processed
    more = train_rows.withColumn("year", F.lit(2012))
    assert fit_dense(more, held, spec=FAST, epochs=1).features == tuple(FEATURE_COLUMNS)


def test_few_partitions_warn(processed):
    with pytest.warns(UserWarning, match="splits"):
        fit_dense(processed[0].repartition(4), spec=FAST, epochs=1, partitions=2)


def test_network_refuses_nothing(processed):
    with pytest.raises(ValueError):
        fit_dense(processed[0].filter("_0 > 5"), epochs=1)


def test_chunks(processed):
    train_rows, held = processed
    model, lines = train.fit_chunks(
        train_rows.withColumn("chunk_id", F.pmod(F.hash("_23"), F.lit(3)).cast("long")), held, spec=FAST, epochs=1, partitions=1
    )
    got = lines.orderBy("chunk_id").collect()
    assert [r.chunk_id for r in got] == [0, 1, 2]
    assert sum(r.rows for r in got) == train_rows.count()
    assert got[-1].val_mae < got[0].val_mae * 1.2


def test_train_evaluate_compare(processed, spark, tmp_path):
    train_rows, held = processed
    root = str(tmp_path)
    assert train.evaluate_production(held, root) is None
    assert registry.load_latest(spark, root, "fare") is None
    assert train.train(train_rows.limit(0), held, root, "linear") is None
    first = train.train(train_rows, held, root, "linear")
    assert train.evaluate_production(held, root) is None  # a new version is in no stage
    with pytest.raises(LookupError):
        registry.promote(spark, root, "fare", 7)
    registry.promote(spark, root, "fare", 1)
    assert train.evaluate_production(held, root) == pytest.approx(first)
    train.train(train_rows, held, root, "gbt", rounds=2)
    models = registry.read_models(spark, root)
    assert registry.model_version(models, "fare") == 1
    assert registry.model_version(models, "fare", "None") == 2
    assert registry.model_version(models, "fare", "Staging") is None
    assert registry.model_version(models, "other") is None
    with pytest.raises(ValueError):
        registry.latest_versions(models, "Retired")
    row = registry.compare_runs(registry.read_runs(spark, root)).first()
    assert row.eval_mae == round(first, 2)
    assert row.improved == (row.train_mae < row.eval_mae)
    registry.promote(spark, root, "fare", 2)
    registry.promote(spark, root, "fare", 1, "Archived")
    models = registry.read_models(spark, root)
    assert registry.model_version(models, "fare") == 2 and registry.model_version(models, "fare", "Archived") == 1
    params = [r.params for r in registry.read_runs(spark, root).orderBy("ts").collect()]
    assert params[0]["kind"] == "linear" and params[1]["model_version"] == "1"


def test_cross_validation(spark, folder):
    trips = with_distance(clean_trips(raw_trips(spark, folder)))
    got = evaluate.cv_linear_mae(trips, "distance", "fare_amount", F.minute("pickup_datetime") % 5).collect()
    assert len(got) == 5 and all(r.slope > 0 for r in got)


def test_requests(spark, folder):
    requests = requests_from_events(read_events(spark, folder))
    line = score.fit_distance_line(clean_trips(raw_trips(spark, folder)))
    scored = score.score_requests(requests, line)
    assert scored.count() == requests.count()
    by = {r.status: r for r in scored.groupBy("status").agg(F.count("fare").alias("fares"), F.count("*").alias("n")).collect()}
    assert by["ok"].fares == by["ok"].n
    assert by["ambiguous"].fares == by["nonexistent"].fares == 0
    holes = requests.withColumn("pickup_latitude", F.when(F.col("request_id") % 5 == 0, F.lit(float("nan"))).when(F.col("request_id") % 5 != 1, F.col("pickup_latitude")))
    found = {r.status: r for r in score.score_requests(holes, line).groupBy("status").agg(F.count("fare").alias("fares"), F.count("*").alias("n")).collect()}
    assert found["missing"].n == requests.filter("request_id % 5 < 2").count() and found["missing"].fares == 0


@pytest.mark.parametrize("kind, options", [("linear", {}), ("gbt", {"rounds": 2}), ("dense", {"spec": FAST, "epochs": 1})])
def test_every_model_scores_trips_and_requests(spark, folder, processed, kind, options):
    model = train.fit(processed[0], kind, **options)
    scorer = score.ml_scorer(model)
    clean = clean_trips(raw_trips(spark, folder))
    scored = score.score(clean, scorer)
    assert scored.columns == [*clean.columns, "prediction"] and scored.filter("prediction IS NULL OR isnan(prediction)").count() == 0
    answers = score.score_requests(requests_from_events(read_events(spark, folder)), scorer)
    assert answers.filter("(status = 'ok') <> (fare IS NOT NULL)").count() == 0


def test_golden_request(spark, trips):
    """17:18 in New York is the hour 17, and the fare is in a plausible range."""
    from farelane.operators.features import time_features

    request = trips({}).drop("key", "fare_amount").withColumn("request_id", F.lit(1))
    timed = score.with_utc(request).withColumn("pickup_datetime", F.col("utc"))
    row = time_features(timed).first()
    assert row.hour_sin == pytest.approx(np.sin(2 * np.pi * 17 / 24))
    assert row.utc_text == "2013-07-06 21:18:00 UTC"
