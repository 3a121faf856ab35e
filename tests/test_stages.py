"""Pipelines of cleaning, features and model, stored and loaded as one."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from farelane.operators.clean import clean_trips, filter_trips
from farelane.plans import stages
from farelane.plans.dense import DenseModel, DenseSpec
from farelane.plans.score import ml_scorer, score
from farelane.schema import CELLS_20, Limits
from farelane.sources.trips import raw_trips


def predictions(df):
    return sorted((r.pickup_datetime, r.fare_amount, round(r.prediction, 6)) for r in df.select("pickup_datetime", "fare_amount", "prediction").collect())


def test_a_loaded_pipeline_scores_raw_trips_alike(spark, folder, tmp_path):
    raw = raw_trips(spark, folder)
    limits = Limits(fare_below=60.0)
    cells = stages.categories(clean_trips(raw, limits), 7)
    made = stages.fit_pipeline(raw, cells=cells, limits=limits, unique=False)
    made.save(str(tmp_path / "p"))
    other = spark.newSession()
    loaded = PipelineModel.load(str(tmp_path / "p"))
    assert [type(s).__name__ for s in loaded.stages] == ["CleanTrips", "TripFeatures", "VectorAssembler", "LinearRegressionModel"]
    assert loaded.stages[1].getOrDefault("cells") == cells and len(loaded.stages[1].columns()) == 25 + 14
    want = predictions(made.transform(raw))
    assert predictions(loaded.transform(raw_trips(other, folder))) == want
    assert len(want) == filter_trips(raw, limits).count() and raw.filter("fare_amount >= 60").count() > 0


def test_a_pipeline_equals_scoring_step_by_step(spark, folder, tmp_path):
    raw = raw_trips(spark, folder)
    spec = DenseSpec(hidden=(3,))
    weights = np.random.default_rng(1).normal(size=sum(int(np.prod(s)) for s in spec.shapes()))
    weights = np.abs(weights)  # variances are not negative
    model = DenseModel(spec, weights)
    stages.bundle(model).save(str(tmp_path / "d"))
    loaded = PipelineModel.load(str(tmp_path / "d"))
    rows = clean_trips(raw)
    got = sorted(round(r.prediction, 5) for r in loaded.transform(raw).select("prediction").collect())
    want = sorted(round(r.prediction, 5) for r in score(rows, ml_scorer(model)).select("prediction").collect())
    assert np.allclose(got, want, atol=1e-4)
    assert (loaded.stages[2].model().weights == weights).all() and tuple(loaded.stages[1].getOrDefault("cells")) == tuple(CELLS_20)


def test_unknown_kind(spark, folder):
    with pytest.raises(ValueError):
        stages.fit_pipeline(raw_trips(spark, folder), "forest")
