"""Fitted pipelines kept in versions under a folder of the shared storage.

``root/version=<n>`` holds one saved model (MLlib persistence), ``root/done/
version=<n>`` a one-row table that is written after it: a version counts only
once that row is there, so a driver that dies while saving leaves the version
before it. Versions are never overwritten. A streaming query names the version
it scores with, so a restart scores with the same one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import child_names, data_digest


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that were saved to the end."""
    found = child_names(spark, f"{root}/done/version=*/_SUCCESS", up=1)
    return sorted(int(name.split("=")[1]) for name in found)


def save_model(model: PipelineModel, spark: SparkSession, root: str, note: str = "") -> int:
    """Save ``model`` as the next version of ``root``; returns its number."""
    taken = [int(n.split("=")[1]) for n in child_names(spark, f"{root}/version=*")]
    version = max([0, *taken]) + 1
    model.write().save(f"{root}/version={version}")
    spark.range(1).select(F.lit(note).alias("note")).coalesce(1).write.parquet(f"{root}/done/version={version}")
    return version


def load_model(spark: SparkSession, root: str, version: int | None = None) -> PipelineModel:
    """A saved version (the last whole one by default)."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise ValueError(f"no {'model' if version is None else f'version {version}'} has been saved to {root}")
    return PipelineModel.load(f"{root}/version={version or known[-1]}")


def fingerprint(pipeline: Pipeline, data: DataFrame) -> str:
    """A digest of what a fit depends on: the stages with their parameters and
    the data (its plan, files, sizes and times). A model that was fitted under
    the same one needn't be fitted again."""
    stages = [
        # Columns that were not set have names with the stage's random id.
        (type(s).__name__, sorted((p.name, str(v)) for p, v in s.extractParamMap().items() if s.isSet(p) or not p.name.endswith(("Col", "Cols"))))
        for s in pipeline.getStages()
    ]
    return hashlib.sha256(repr((stages, data_digest(data))).encode()).hexdigest()


def stored_fit(root: str, pipeline: Pipeline, data: DataFrame, fit: Callable[[], PipelineModel]) -> tuple[PipelineModel, int]:
    """(model, version) for ``pipeline`` on ``data``: loaded if a version of
    ``root`` has their fingerprint, else fitted by ``fit`` and saved."""
    spark = data.sparkSession
    mark = fingerprint(pipeline, data)
    for version in reversed(versions(spark, root)):
        if spark.read.parquet(f"{root}/done/version={version}").first()["note"] == mark:
            return load_model(spark, root, version), version
    return (model := fit()), save_model(model, spark, root, mark)
