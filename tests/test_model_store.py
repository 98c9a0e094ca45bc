import os

import pytest

from quarry.ml import models as MO
from quarry.ml import store as ST
from quarry.ml.split import hash_split
from quarry.plans import tables_ml as TM
from quarry.plans import tables_stream as TS
from quarry.streaming.scoring import confusion_per_batch
from quarry.streaming.sinks import run_available

SF = "/root/testdata/sf0.001"


def tree(depth=2):
    return MO.forest_pipeline(TM.TREE_COLUMNS, "label", num_trees=1, max_depth=depth, bootstrap=False, feature_subset="all")


def train(spark):
    return hash_split(TM.tree_frame(spark, SF), ["id"], 0.7, seed=4)[0]


def scores(model, df):
    return {r.id: (float(r.probability[1]), r.prediction) for r in model.transform(df).collect()}


def test_versions(spark, tmp_dir):
    data = train(spark)
    first, second = tree(1).fit(data), tree(2).fit(data)
    with pytest.raises(ValueError):
        ST.load_model(spark, tmp_dir)
    assert [ST.save_model(m, spark, tmp_dir) for m in (first, second)] == [1, 2]
    assert scores(ST.load_model(spark, tmp_dir), data) == scores(second, data)
    assert scores(ST.load_model(spark, tmp_dir, 1), data) == scores(first, data)
    # A save that was cut off doesn't count, and its number isn't used again.
    os.remove(f"{tmp_dir}/done/version=2/_SUCCESS")
    assert ST.versions(spark, tmp_dir) == [1]
    assert scores(ST.load_model(spark, tmp_dir), data) == scores(first, data)
    assert ST.save_model(second, spark, tmp_dir) == 3


def test_fitted_once_per_stages_and_data(spark, tmp_dir):
    fits = []

    def run(pipeline, data):
        def fit():
            fits.append(1)
            return pipeline.fit(data)

        return ST.stored_fit(tmp_dir, pipeline, data, fit)

    model, version = run(tree(), train(spark))
    again, same = run(tree(), train(spark))
    assert (version, same, len(fits)) == (1, 1, 1) and scores(model, train(spark)) == scores(again, train(spark))
    assert run(tree(1), train(spark))[1] == 2 and run(tree(), train(spark).filter("id > 10"))[1] == 3 and len(fits) == 3


def test_a_tree_of_known_splits(spark):
    """Four cells with their own shares of the label: the splits lie between them."""
    rows = [(float(a), float(b), float(i < k)) for a, b, k in ((0, 0, 9), (0, 5, 3), (7, 0, 1), (7, 5, 6)) for i in range(10)]
    df = spark.createDataFrame(rows, "nation double, digit double, label double")
    model = tree().fit(df)
    got = {(r.nation, r.digit): (float(r.probability[1]), r.prediction) for r in model.transform(df).collect()}
    assert got == {(0, 0): (0.9, 1.0), (0, 5): (0.3, 0.0), (7, 0): (0.1, 0.0), (7, 5): (0.6, 1.0)}
    forest = model.stages[-1]
    assert forest.trees[0].depth == 2 and sum(forest.featureImportances.toArray()) == pytest.approx(1.0)


def test_a_stream_that_dies_goes_on_with_the_saved_model(spark, tmp_dir):
    """The job stops in its third batch; a new one loads the same version and
    resumes from the checkpoint: the counts are those of one whole run."""
    _, version, root = TM.fit_tree(spark, SF)
    test, stream = TS.tree_stream(spark, SF)
    out, ck = f"{tmp_dir}/out", f"{tmp_dir}/ck"
    take = confusion_per_batch(ST.load_model(spark, root, version), out, "label")

    def dies(batch, batch_id):
        if batch_id == 2:
            batch.write.parquet(f"{out}/batch_id={batch_id}")  # half of its work is done
            raise RuntimeError("killed")
        take(batch, batch_id)

    with pytest.raises(Exception, match="killed"):
        run_available(stream, "append", checkpoint=ck, foreach_batch=dies)
    assert sorted(os.listdir(out)) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    loaded = ST.load_model(spark, root, version)
    run_available(stream, "append", checkpoint=ck, foreach_batch=confusion_per_batch(loaded, out, "label"))
    counts = spark.read.schema("label double, prediction double, n long").parquet(f"{out}/batch_id=*")
    got = {(r.label, r.prediction): r.n for r in counts.groupBy("label", "prediction").sum("n").toDF("label", "prediction", "n").collect()}
    want = {(r.label, r.prediction): r["count"] for r in loaded.transform(test).groupBy("label", "prediction").count().collect()}
    assert got == want and len(os.listdir(out)) == 4
