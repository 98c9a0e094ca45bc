"""Classifier metrics as DataFrame aggregates.

* ``class_metrics`` -- accuracy and label-frequency-weighted precision,
  recall and F1 (the definitions of MLlib's multiclass evaluator).
* ``binary_auc``    -- exact area under the ROC curve (ties count half),
  i.e. the evaluator's value without down-sampling.

Both first aggregate by key with map-side partial sums, so a class or a
score holding a large share of the rows costs one partial row per task. A
null label, prediction or score raises an error: it is neither a class nor a
negative.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _known(x: Column | str, what: str) -> Column:
    """The value as a double; null raises."""
    missing = F.raise_error(F.lit(f"null {what}: drop or fill such rows before computing metrics"))
    return F.coalesce(_c(x).cast("double"), missing.cast("double"))


def confusion(
    df: DataFrame,
    label: Column | str,
    prediction: Column | str,
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by..., label, prediction, n)``: bounded by groups x classes^2."""
    return df.groupBy(
        *by,
        _known(label, "label").alias("label"),
        _known(prediction, "prediction").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def class_metrics(
    df: DataFrame,
    label: Column | str = "label",
    prediction: Column | str = "prediction",
    digits: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """``accuracy, weighted_precision, weighted_recall, weighted_f1`` (one
    row, or one row per ``by`` group, computed in the same pass).

    Classes are the labels that occur; a class never predicted has
    precision 0; F1 is 0 when precision + recall is 0.
    """
    keys = list(by)
    # One pass: every confusion row counts for its label's class and for its
    # prediction's class.
    role = lambda c, n_c, tp, n_p: F.struct(
        F.col(c).alias("c"), n_c.alias("n_c"), tp.alias("tp"), n_p.alias("n_p")
    )
    none, n = F.lit(0).cast("long"), F.col("n")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    roles = F.array(role("label", n, hit, none), role("prediction", none, none, n))
    per = (
        confusion(df, label, prediction, keys).select(*keys, F.explode(roles).alias("r"))
        .groupBy(*keys, F.col("r.c").alias("c"))
        .agg(F.sum("r.n_c").alias("n_c"), F.sum("r.tp").alias("tp"), F.sum("r.n_p").alias("n_p"))
        .filter(F.col("n_c") > 0)
        .select(
            *keys,
            "n_c",
            "tp",
            F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_p")), F.lit(0.0)).alias("prec"),
            F.try_divide(F.col("tp").cast("double"), F.col("n_c")).alias("rec"),
        )
    )
    f1 = F.when(
        F.col("prec") + F.col("rec") > 0,
        2.0 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec")),
    ).otherwise(F.lit(0.0))
    per = per.withColumn("f1", f1)
    n = F.sum("n_c")
    out = per.groupBy(*keys).agg(
        F.try_divide(F.sum("tp").cast("double"), n).alias("accuracy"),
        F.try_divide(F.sum(F.col("n_c") * F.col("prec")), n).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("n_c") * F.col("rec")), n).alias("weighted_recall"),
        F.try_divide(F.sum(F.col("n_c") * F.col("f1")), n).alias("weighted_f1"),
    )
    if digits is not None:
        out = out.select(
            *keys, *[F.round(c, digits).alias(c) for c in out.columns if c not in keys]
        )
    return out


def binary_auc(
    df: DataFrame,
    label: Column | str = "label",
    score: Column | str = "score",
    alias: str = "auc",
    partitions: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """One row with the exact ROC AUC of ``score`` for ``label > 0.5``.

    Mann-Whitney form: ``sum over positives of (#negatives scored lower +
    half the negatives scored equal) / (P * N)``. The "negatives below"
    prefix sum is distributed: scores are range-partitioned and the
    partition ids frozen in a written table, per-partition totals (one row per partition, so a
    bounded broadcast) give each partition its offset, and a window inside
    each partition finishes the sum.
    """
    spark = df.sparkSession
    pos = F.when(_known(label, "label") > 0.5, 1).otherwise(0)
    g = df.groupBy(_known(score, "score").alias("score")).agg(
        F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg")
    )
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        g.repartitionByRange(n_parts, "score").withColumn("pid", F.spark_partition_id()),
        "auc-ranges",
    )
    totals = ranged.groupBy("pid").agg(F.sum("neg").alias("pneg"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("pid", F.coalesce(F.sum("pneg").over(before), F.lit(0)).alias("off"))
    inside = Window.partitionBy("pid").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = ranged.join(F.broadcast(offsets), "pid").select(
        "pos",
        "neg",
        (F.col("off") + F.coalesce(F.sum("neg").over(inside), F.lit(0))).alias("neg_below"),
    )
    u = below.agg(
        F.sum(F.col("pos") * (F.col("neg_below") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("q"),
    )
    auc = F.try_divide(F.col("u"), F.col("p").cast("double") * F.col("q"))
    if digits is not None:
        auc = F.round(auc, digits)
    return u.select(auc.alias(alias))
