"""Run log and model store: two append-only tables below a root folder.

Every append is a folder of its own, so writers at the same time don't meet in Spark's
temporary folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from farelane.schema import MODELS, RUNS
from farelane.staging import create_new

STAGES = ("None", "Production", "Staging", "Archived")


def append_runs(runs: DataFrame, root: str) -> None:
    """Append run rows to the log."""
    runs.select(*RUNS.names).write.parquet(f"{root}/runs/{uuid.uuid4().hex}")


def log_run(
    spark: SparkSession,
    root: str,
    context: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    run_id: str | None = None,
) -> str:
    """Record one train or evaluate run."""
    run_id = run_id or uuid.uuid4().hex
    row = (run_id, context, {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()})
    runs = spark.createDataFrame(
        [row], "run_id string, context string, params map<string,string>, metrics map<string,double>"
    )
    append_runs(runs.withColumn("ts", F.current_timestamp()), root)
    return run_id


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # nothing was written yet


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/runs", RUNS)


def read_models(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/models", MODELS)


def _checked(stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {', '.join(STAGES)}")
    return stage


def current_stages(models: DataFrame) -> DataFrame:
    """``(name, version, stage, kind, path)``: each version with the stage it was given last."""
    last = F.coalesce("seq", F.lit(0))
    return models.groupBy("name", "version").agg(
        F.max_by("stage", last).alias("stage"), F.max_by("kind", last).alias("kind"), F.max_by("path", last).alias("path")
    )


def latest_versions(models: DataFrame, stage: str = "Production") -> DataFrame:
    """Newest version per model name in a stage: ``(name, version, path, kind)``."""
    return (
        current_stages(models)
        .filter(F.col("stage") == _checked(stage))
        .groupBy("name")
        .agg(
            F.max("version").alias("version"),
            F.max_by("path", "version").alias("path"),
            F.max_by("kind", "version").alias("kind"),
        )
    )


def model_version(models: DataFrame, name: str, stage: str = "Production") -> int | None:
    """Newest version number of a model in a stage, None when there is none."""
    found = latest_versions(models, stage).filter(F.col("name") == name).first()
    return None if found is None else found.version


def batch_version(models: DataFrame, name: str, batch_id: int) -> int | None:
    """The version that a micro-batch has stored, None when it has stored none."""
    return models.filter((F.col("name") == name) & (F.col("batch_id") == batch_id)).agg(F.max("version")).first()[0]


def _append_model(spark: SparkSession, root: str, row: tuple) -> None:
    """``row``: name, version, stage, kind, path, batch_id, seq."""
    rows = spark.createDataFrame([row], "name string, version int, stage string, kind string, path string, batch_id long, seq int")
    rows.withColumn("ts", F.current_timestamp()).select(*MODELS.names).write.parquet(f"{root}/models/{uuid.uuid4().hex}")


def save_model(
    spark: SparkSession, root: str, name: str, model, kind: str, stage: str = "None", batch_id: int | None = None
) -> tuple[int, str]:
    """Store a model as the next version; ``model`` offers ``save(path)``.

    A new version is in no stage until :func:`promote` gives it one. ``batch_id`` names
    the micro-batch it comes from, in the same row. The number is claimed before the model is
    written, so savers at the same time get different ones; a claim whose saver dies leaves a gap.
    """
    _checked(stage)
    known = read_models(spark, root).filter(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (known or 0) + 1
    while not create_new(spark, f"{root}/claims/{name}/{version:06d}"):
        version += 1
    path = f"{root}/artifacts/{name}/{version:06d}-{time.strftime('%Y%m%d-%H%M%S')}"
    model.save(path)
    _append_model(spark, root, (name, version, stage, kind, path, batch_id, 0))
    return version, path


def promote(spark: SparkSession, root: str, name: str, version: int, stage: str = "Production") -> None:
    """Put a stored version into a stage, by one more row; what was there before stays a row, too."""
    rows = read_models(spark, root).filter((F.col("name") == name) & (F.col("version") == version))
    last = rows.orderBy(F.desc("seq")).first()
    if last is None:
        raise LookupError(f"no version {version} of {name}")
    _append_model(spark, root, (name, version, _checked(stage), last.kind, last.path, last.batch_id, last.seq + 1))


def load_latest(spark: SparkSession, root: str, name: str, stage: str = "Production"):
    """The newest model of a stage, or None."""
    found = latest_versions(read_models(spark, root), stage).filter(F.col("name") == name).first()
    return None if found is None else _loaders()[found.kind](spark, found.path)


def load_version(spark: SparkSession, root: str, name: str, version: int):
    """One stored version."""
    found = read_models(spark, root).filter((F.col("name") == name) & (F.col("version") == version)).first()
    if found is None:
        raise LookupError(f"no version {version} of {name}")
    return _loaders()[found.kind](spark, found.path)


def _loaders():
    from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel

    from farelane.plans.dense import DenseModel

    return {
        "linear": lambda spark, path: LinearRegressionModel.load(path),
        "gbt": lambda spark, path: GBTRegressionModel.load(path),
        "dense": DenseModel.load,
    }


def compare_runs(runs: DataFrame) -> DataFrame:
    """Latest evaluation against latest training MAE: ``(eval_mae, train_mae, delta, improved)``."""
    mae = F.round(F.col("metrics")["mae"], 2)
    latest = runs.agg(
        F.max_by(F.when(F.col("context") == "evaluate", mae), F.when(F.col("context") == "evaluate", F.col("ts"))).alias("eval_mae"),
        F.max_by(F.when(F.col("context") == "train", mae), F.when(F.col("context") == "train", F.col("ts"))).alias("train_mae"),
    )
    delta = F.round(F.col("train_mae") - F.col("eval_mae"), 2)
    return latest.select("eval_mae", "train_mae", delta.alias("delta"), (delta < 0).alias("improved"))
