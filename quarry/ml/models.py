"""Model builders on MLlib estimators (fitting stays in MLlib)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame

from quarry.ml.features import Columns, feature_stages


def logistic_pipeline(
    columns: Columns,
    label: str,
    label_index: str = "known_label",
    features: str = "features",
    max_iter: int = 100,
    tol: float = 1e-6,
) -> Pipeline:
    """Features from ``columns``, the string ``label`` as an index, and a
    logistic regression without penalty."""
    return Pipeline(stages=[
        *feature_stages(columns, features),
        StringIndexer(inputCol=label, outputCol=label_index),
        LogisticRegression(featuresCol=features, labelCol=label_index, maxIter=max_iter, tol=tol),
    ])


def forest_pipeline(
    columns: Columns,
    label: str,
    features: str = "features",
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = 4,
    max_memory_mb: int = 1024,
    bootstrap: bool = True,
    feature_subset: str = "auto",
) -> Pipeline:
    """Features from ``columns`` (unseen categories kept) and a random forest.

    The seed is fixed so the trees do not depend on the Python process.
    ``max_memory_mb`` lets one pass over the data split more tree nodes at
    once (fewer passes); node ids are cached between levels so the trees
    are not re-shipped to the executors every pass. One tree without
    ``bootstrap`` over ``all`` features is the plain best-split tree.
    """
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol=features,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        maxMemoryInMB=max_memory_mb,
        cacheNodeIds=True,
        bootstrap=bootstrap,
        featureSubsetStrategy=feature_subset,
    )
    return Pipeline(stages=[*feature_stages(columns, features, keep_unseen=True), forest])


def spread(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """``df`` in at least ``partitions`` partitions. One with fewer is dealt by
    a hash of ``keys`` and sorted within, so the rows of a partition and their
    order do not depend on cores or files; one with as many is left alone."""
    if df.rdd.getNumPartitions() >= partitions:
        return df
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def fit(
    pipeline: Pipeline,
    train: DataFrame,
    keys: Sequence[str] = (),
    partitions: int | None = None,
) -> PipelineModel:
    """Fit ``pipeline`` on ``train``.

    With ``keys`` and ``partitions`` an input that arrives in fewer partitions
    is spread first (:func:`spread`) and cached for the learner's passes:
    worth it for learners that do heavy per-row work each pass, such as
    trees, whose samples are drawn per partition. The partition count is a
    parameter of its own, not the cluster's core count, so the same input
    gives the same trees anywhere. An input of more partitions is not changed.
    """
    if not partitions:
        return pipeline.fit(train)
    held = spread(train, keys, partitions).persist()
    try:
        return pipeline.fit(held)
    finally:
        held.unpersist()
