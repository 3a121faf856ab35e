"""Cleaning, features and model as one stored pipeline, so scoring can't drift from training."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

import numpy as np
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from farelane.operators.clean import clean_trips, filter_trips
from farelane.operators.districts import top_districts
from farelane.operators.features import to_vector, trip_features
from farelane.plans.dense import DenseModel, DenseSpec
from farelane.schema import CELLS_20, DEFAULT_LIMITS, FEATURE_COLUMNS, Limits


class _Stored(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose parameters are all that has to be stored."""


class CleanTrips(_Stored):
    """Raw trips without bad rows and, with ``unique``, without duplicates."""

    limits = Param(Params._dummy(), "limits", "limits of the cleaning rules, as JSON", TypeConverters.toString)
    unique = Param(Params._dummy(), "unique", "whether duplicates go, too", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, limits: str = json.dumps(asdict(DEFAULT_LIMITS)), unique: bool = True):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limits = Limits(**json.loads(self.getOrDefault(self.limits)))
        return clean_trips(dataset, limits) if self.getOrDefault(self.unique) else filter_trips(dataset, limits)


class TripFeatures(_Stored):
    """Trips with their feature columns; ``cells`` are the districts that have a column for each end."""

    cells = Param(Params._dummy(), "cells", "geohash districts in column order", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, cells: Sequence[str] = tuple(CELLS_20)):
        super().__init__()
        self._set(cells=list(self._input_kwargs.get("cells", CELLS_20)))

    def columns(self) -> list[str]:
        plain = len(FEATURE_COLUMNS) - 2 * len(CELLS_20)
        return [f"_{k}" for k in range(plain + 2 * len(self.getOrDefault(self.cells)))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return trip_features(dataset, self.getOrDefault(self.cells), keep=tuple(dataset.columns))


class DenseScorer(_Stored):
    """A network as a stage; it adds ``prediction``."""

    spec = Param(Params._dummy(), "spec", "layout of the network, as JSON", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "all weights", TypeConverters.toListFloat)
    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, spec: str = "{}", weights: Sequence[float] = (), features: Sequence[str] = ()):
        super().__init__()
        self._set(**{k: v if isinstance(v, str) else list(v) for k, v in self._input_kwargs.items()})

    @classmethod
    def of(cls, model: DenseModel) -> DenseScorer:
        return cls(spec=json.dumps(asdict(model.spec)), weights=[float(w) for w in model.weights], features=list(model.features))

    def model(self) -> DenseModel:
        spec = json.loads(self.getOrDefault(self.spec))
        spec["hidden"] = tuple(spec["hidden"])
        return DenseModel(DenseSpec(**spec), np.array(self.getOrDefault(self.weights)), tuple(self.getOrDefault(self.features)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model().transform(dataset)


def categories(trips: DataFrame, k: int = 20) -> list[str]:
    """The ``k`` districts that most clean trips start or end in, by name."""
    return sorted(r["cell"] for r in top_districts(trips, k).collect())


def bundle(model, cells: Sequence[str] = CELLS_20, limits: Limits = DEFAULT_LIMITS, unique: bool = True) -> PipelineModel:
    """One pipeline from raw trips to ``prediction`` around a fitted linear, tree or network model.

    ``save`` and ``PipelineModel.load`` keep limits, districts and model together.
    """
    made = TripFeatures(cells=list(cells))
    first = [CleanTrips(limits=json.dumps(asdict(limits)), unique=unique), made]
    if isinstance(model, DenseModel):
        return PipelineModel([*first, DenseScorer.of(model)])
    return PipelineModel([*first, VectorAssembler(inputCols=made.columns(), outputCol="features", handleInvalid="keep"), model])


def fit_pipeline(
    trips: DataFrame, kind: str = "linear", cells: Sequence[str] = CELLS_20, limits: Limits = DEFAULT_LIMITS, unique: bool = True
) -> PipelineModel:
    """Clean raw trips, fit a ``linear`` or ``gbt`` model on their features, and return the whole way as one pipeline."""
    made = TripFeatures(cells=list(cells)).columns()
    clean = clean_trips(trips, limits) if unique else filter_trips(trips, limits)
    rows = to_vector(trip_features(clean, cells, target=True), made, f"_{len(made)}")
    learner = {"linear": LinearRegression(solver="normal", regParam=1e-6), "gbt": GBTRegressor(maxIter=10, maxDepth=4, seed=7)}
    if kind not in learner:
        raise ValueError(f"unknown kind {kind!r}, use linear or gbt")
    return bundle(learner[kind].fit(rows), cells, limits, unique)
