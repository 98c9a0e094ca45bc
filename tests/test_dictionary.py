import random

import pytest
from pyspark.sql import functions as F

from quarry.ml import dictionary as D
from quarry.ml import features as FE


def frame(spark, values):
    return spark.createDataFrame([(i, v, "c") for i, v in enumerate(values)], "id long, key string, salt string")


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_ranks_are_the_indexers(spark, partitions):
    rng = random.Random(1)
    values = [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(800)] + ["hot"] * 700 + ["é", "", " "]
    df = frame(spark, values)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        words = D.build_dictionary(df, "key")
        got = {r.id: r.i for r in D.encode(df, "key", words, "i").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = {r.id: int(r.i) for r in FE.index_strings(df, df, "key", "i").collect()}
    assert got == want and words.size == len(set(values))
    assert sorted(r["index"] for r in words.table.collect()) == list(range(words.size))


def test_nulls_and_unseen_values(spark):
    words = D.build_dictionary(frame(spark, ["a", "a", "b", None]), "key")
    assert words.size == 2
    other = frame(spark, ["b", "zz", None, "a"])
    keep = {r.id: r.i for r in D.encode(other, "key", words, "i", unseen="keep").collect()}
    assert keep == {0: 1, 1: 2, 2: 2, 3: 0}
    assert {r.id for r in D.encode(other, "key", words, "i", unseen="skip").collect()} == {0, 3}
    with pytest.raises(Exception, match="not in the dictionary"):
        D.encode(other, "key", words, "i").collect()
    with pytest.raises(ValueError):
        D.encode(other, "key", words, "i", unseen="drop")


def test_names_are_kept_and_values_come_back(spark, tmp_dir):
    df = frame(spark, ["x", "y", "x"]).withColumn("value", F.lit(1)).withColumn("found", F.lit(2)).withColumn("row", F.lit(3))
    D.build_dictionary(df, "key", f"{tmp_dir}/words")
    words = D.load_dictionary(spark, f"{tmp_dir}/words")
    out = D.encode(df, "key", words, "i")
    assert out.columns == [*df.columns, "i"]
    back = D.decode(out.withColumn("i", F.col("i") + F.when(F.col("id") == 2, 9).otherwise(0)), "i", words, "again")
    assert {r.id: r.again for r in back.collect()} == {0: "x", 1: "y", 2: None}


def test_a_value_per_row_and_no_labels_on_the_driver(spark, monkeypatch):
    df = spark.range(20000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    plain = type(df).collect

    def few(self):
        rows = plain(self)
        assert len(rows) <= 8
        return rows

    monkeypatch.setattr(type(df), "collect", few)
    words = D.build_dictionary(df, "key")
    out = D.encode(df, "key", words, "i")
    assert out.agg(F.countDistinct("i")).first()[0] == words.size == 20000


def test_hot_values_are_spread(spark):
    """Two thirds of the rows in one value: no partition of the join holds them all."""
    n = 30000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"))
    words = D.build_dictionary(df, "key")
    held = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 << 20), "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for name in held:
        spark.conf.set(name, "false" if name.endswith("enabled") else "-1")
    try:
        out = D.encode(df, "key", words, "i")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    assert sum(sizes) == n and max(sizes) < n / 2


def test_empty(spark):
    df = frame(spark, [])
    words = D.build_dictionary(df, "key")
    assert words.size == 0 and D.encode(df, "key", words, "i").count() == 0
