"""Per-micro-batch scoring: apply a fitted model to each batch of a stream
and append that batch's metrics as rows ``(batch_id, metric columns)``."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from quarry.ml.metrics import class_metrics, confusion


def metrics_per_batch(
    model: PipelineModel | None,
    metrics_path: str,
    label_col: str,
    prediction_col: str = "prediction",
    digits: int | None = None,
):
    """A ``foreachBatch`` function. Empty batches are skipped (metrics of
    nothing are undefined); each batch's metrics are one distributed
    aggregate written to ``metrics_path/batch_id=<id>`` with overwrite, so
    a batch replayed after a failure replaces its own row (exactly once)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        preds = model.transform(batch) if model is not None else batch
        m = class_metrics(preds, label_col, prediction_col, digits=digits)
        m.write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")

    return handle


def confusion_per_batch(model: PipelineModel | None, path: str, label_col: str, prediction_col: str = "prediction"):
    """A ``foreachBatch`` function: each batch's counts ``(label, prediction,
    n)`` to ``path/batch_id=<id>`` with overwrite, so a replayed batch replaces
    its own. The counts of several batches add up, their metrics don't."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        preds = model.transform(batch) if model is not None else batch
        confusion(preds, label_col, prediction_col).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return handle
