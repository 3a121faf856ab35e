"""Incremental training on micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from farelane.plans import registry
from farelane.plans.dense import DenseSpec, fit_dense
from farelane.plans.evaluate import evaluate
from farelane.schema import TARGET_COLUMN


def stream_fit(
    processed: DataFrame,
    valid: DataFrame,
    root: str,
    checkpoint: str,
    name: str = "stream",
    spec: DenseSpec | None = None,
    epochs: int = 100,
    patience: int = 2,
    every: str | None = None,
    stage: str = "Production",
) -> StreamingQuery:
    """Continue the stored network with every micro-batch of processed rows.

    The stored version carries the batch id, in one row with the model. A batch that is
    replayed after a failure finds that row and trains nothing; it only writes the
    run-log row if that is still missing. The first version goes to ``stage``, and so do
    its successors: a stream is its own line of models.
    """

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = f"{name}-batch-{batch_id}"
        done = registry.batch_version(registry.read_models(spark, root), name, batch_id)
        if done is None:
            if batch.isEmpty():
                return
            warm = registry.load_latest(spark, root, name, stage)
            model = fit_dense(batch, valid, warm, spec, epochs, patience)
            done, _ = registry.save_model(spark, root, name, model, "dense", stage, batch_id)
        elif not registry.read_runs(spark, root).filter(F.col("run_id") == run_id).isEmpty():
            return
        model = registry.load_version(spark, root, name, done)
        found = evaluate(model.transform(valid), truth=TARGET_COLUMN).first()
        registry.log_run(
            spark, root, "train", {"batch_id": batch_id, "model_version": done}, {"mae": found.mae, "loss": found.loss}, run_id
        )

    writer = processed.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()
