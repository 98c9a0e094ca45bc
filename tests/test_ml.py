import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import vector_to_array

from quarry.ml import features as FE
from quarry.ml import metrics as M
from quarry.ml import models as MO
from quarry.ml.split import hash_split


def test_bucket_edges(spark):
    vals = [39.999, 40.0, 50.0, 69.9, 70.0, -1e9]
    df = spark.createDataFrame([(v,) for v in vals], "age double")
    out = FE.bucketize(df, "age", "b", [-float("inf"), 40, 50, 60, 70, float("inf")]).collect()
    assert [r.b for r in out] == [0.0, 1.0, 2.0, 3.0, 4.0, 0.0]


def test_indexer_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([(s,) for s in "babac"], "s string")
    idx = {r.s: r.i for r in FE.index_strings(df, df, "s", "i").collect()}
    assert idx == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_one_hot_unseen_kept(spark):
    train = spark.createDataFrame([(s,) for s in "babac"], "s string")
    allv = train.union(spark.createDataFrame([("zz",)], "s string"))
    ix = FE.string_indexer("s", "i", keep_unseen=True).fit(train).transform(allv)
    enc = OneHotEncoder(inputCols=["i"], outputCols=["v"]).fit(ix).transform(ix)
    rows = {r.s: r.v for r in enc.select("s", vector_to_array("v").alias("v")).collect()}
    assert len(rows["a"]) == 3 and rows["zz"] == [0.0, 0.0, 0.0] and rows["a"] == [1.0, 0.0, 0.0]


def test_weighted_metrics_golden_and_evaluator(spark):
    pairs = [(0, 0), (0, 1), (1, 1), (2, 2), (2, 0), (1, 1)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    m = M.class_metrics(df).collect()[0]
    assert m.accuracy == pytest.approx(0.6667, abs=1e-4)
    assert m.weighted_precision == pytest.approx(0.7222, abs=1e-4)
    assert m.weighted_recall == pytest.approx(0.6667, abs=1e-4)
    assert m.weighted_f1 == pytest.approx(0.6556, abs=1e-4)
    for name, val in [
        ("accuracy", m.accuracy),
        ("weightedPrecision", m.weighted_precision),
        ("weightedRecall", m.weighted_recall),
        ("weightedFMeasure", m.weighted_f1),
    ]:
        ev = MulticlassClassificationEvaluator(metricName=name)
        assert ev.evaluate(df) == pytest.approx(val, abs=1e-12)


def test_auc_matches_evaluator_without_binning(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.random() < 0.4), float(rnd.randint(0, 60))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label double, score double")
    got = M.binary_auc(df).collect()[0].auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert got == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a, _ = hash_split(df, ["k"], 0.7, seed=4)
    b, _ = hash_split(df.repartition(13), ["k"], 0.7, seed=4)
    ka = sorted(r.k for r in a.collect())
    assert ka == sorted(r.k for r in b.collect())
    assert 0.65 < len(ka) / 5000 < 0.75


def test_logistic_metrics_match_evaluators(spark):
    from quarry.plans import tables_ml as TM

    sf = "/root/testdata/sf0.001"
    got = TM.logistic_metrics(spark, sf).collect()[0]
    train, _ = hash_split(TM.customer_frame(spark, sf), ["id"], 0.7, seed=4)
    preds = TM.fit_logistic(spark, sf).transform(train)
    auc = BinaryClassificationEvaluator(labelCol="known_label", numBins=0).evaluate(preds)
    acc = MulticlassClassificationEvaluator(labelCol="known_label", metricName="accuracy").evaluate(preds)
    assert got.auc == pytest.approx(auc, abs=1e-8) and got.accuracy == pytest.approx(acc, abs=1e-8)


def test_forest_metrics_match_evaluators(spark):
    from quarry.plans import tables_ml as TM

    sf = "/root/testdata/sf0.001"
    got = {r.split: r for r in TM.forest_metrics(spark, sf).collect()}
    preds = TM._forest_predictions(spark, sf).persist()
    for split in ("train", "test"):
        for name, column in (("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                             ("weightedRecall", "weighted_recall"), ("weightedFMeasure", "weighted_f1")):
            ev = MulticlassClassificationEvaluator(labelCol="rating", metricName=name)
            assert got[split][column] == pytest.approx(ev.evaluate(preds.where(preds.split == split)), abs=1e-8)
    preds.unpersist()


def test_forest_follows_no_input_partitions_below_the_bound(spark):
    """However few partitions the input has, the trees are the same."""
    from quarry.plans import tables_ml as TM

    data = TM.retail_frame(spark, "/root/testdata/sf0.001").persist()
    pipeline = MO.forest_pipeline(TM.FOREST_COLUMNS, "rating", num_trees=5, max_depth=4)
    trees = []
    for n in (2, 8):
        model = MO.fit(pipeline, data.repartition(n), keys=["o_orderkey"], partitions=16)
        trees.append(model.stages[-1].toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1]
    data.unpersist()


def test_forest_scores_few_files_in_many_tasks(spark, monkeypatch):
    from quarry.plans import tables_ml as TM

    sf = "/root/testdata/sf0.001"
    data = TM.retail_frame(spark, sf)
    model = MO.fit(MO.forest_pipeline(TM.FOREST_COLUMNS, "rating", num_trees=2, max_depth=2), data)
    monkeypatch.setattr(TM, "fit_forest", lambda *_: model)
    assert TM._forest_predictions(spark, sf).rdd.getNumPartitions() >= TM.FOREST_PARTITIONS
    assert TM.forest_model(spark, sf).rdd.getNumPartitions() >= TM.FOREST_PARTITIONS


def test_spread_leaves_many_partitions_alone(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    assert MO.spread(df.repartition(64), ["k"], 16).rdd.getNumPartitions() == 64
    assert MO.spread(df.coalesce(1), ["k"], 16).rdd.getNumPartitions() == 16


def test_feature_stages_count_all_categories_in_one_stage(spark):
    columns = FE.Columns(bucketed={"x": [-1.0, 0.5, 2.0]}, indexed=["a"], one_hot=["b", "c"], plain=["x"], scaled=["x", "y"])
    stages = FE.feature_stages(columns, "v", keep_unseen=True, prefix="t")
    assert sum(type(s).__name__ == "StringIndexer" for s in stages) == 1
    df = spark.createDataFrame([("p", "q", "r", 0.0, 1.0), ("p", "s", "r", 1.0, 3.0)], "a string, b string, c string, x double, y double")
    out = Pipeline(stages=stages).fit(df).transform(df).select(vector_to_array("v").alias("v")).collect()
    # bucket, index, one-hot b (2, no extra), one-hot c (1), x, scaled x and y
    assert [len(r.v) for r in out] == [8, 8] and out[1].v[:2] == [1.0, 0.0] and out[1].v[5] == 1.0
    assert out[1].v[6] == pytest.approx(2**0.5) and out[1].v[7] == pytest.approx(3 / 2**0.5)


@pytest.mark.parametrize("rows", [[(None, 1.0)], [(1.0, None)]])
def test_null_labels_predictions_and_scores_raise(spark, rows):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 0.5), *rows], "label double, score double")
    with pytest.raises(Exception, match="null (label|prediction)"):
        M.class_metrics(df, "label", "score").collect()
    with pytest.raises(Exception, match="null (label|score)"):
        M.binary_auc(df).collect()


def test_class_metrics_reads_its_input_once(spark, tmp_dir):
    spark.createDataFrame([(0.0, 1.0)], "label double, prediction double").write.parquet(f"{tmp_dir}/p")
    m = M.class_metrics(spark.read.parquet(f"{tmp_dir}/p"))
    assert m._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_grouped_metrics_equal_per_group(spark):
    rnd = random.Random(11)
    rows = [(g, float(rnd.randint(0, 2)), float(rnd.randint(0, 3))) for g in ("a", "b") for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, label double, prediction double")
    grouped = {r.g: r for r in M.class_metrics(df, by=["g"]).collect()}
    for g in ("a", "b"):
        single = M.class_metrics(df.filter(df.g == g)).collect()[0]
        for c in ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1"):
            assert grouped[g][c] == pytest.approx(single[c], abs=1e-12)
