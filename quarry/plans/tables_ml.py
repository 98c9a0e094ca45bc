"""Catalogue entries for feature stages, models and metrics.

Mappings of the reference's inputs onto the driver tables:

* bucketing: ``p_size`` of part at 10 / 20 / 30 / 40;
* indexing and one-hot: ``c_mktsegment`` of customer; the keep-unseen
  indexer is fitted on the small parts (``p_size <= 2``) and applied to all
  parts, so brands missing from the fit set take the extra index;
* assembling and scaling: ``(p_size, p_retailprice)`` of part;
* class metrics: orders with label ``o_orderkey % 3`` and prediction 0 for
  every fourth customer, else the label;
* AUC: customers, label ``c_acctbal > 4000``, score
  ``c_custkey % 50 + floor(c_acctbal / 500)``;
* logistic model: customers, bucketed balance + segment index + nation,
  label "rich" / "other"; forest: orders with customer attributes, label =
  priority digit; both trained on a 70 % hash split of the key.

Forests come from a model store in the application's folder: the first key
that needs one fits and saves it, the next ones load it (the fit depends on
stages and data alone, so no result depends on what ran before). What SQL can
say of a fitted model has keys of its own: ``logistic_score_equations`` (at
the maximum the predicted sums equal the observed ones, feature by feature)
and ``forest_label_totals`` (the confusion counts add up to the labels).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.ml import dictionary as D
from quarry.ml import features as FE
from quarry.ml import metrics as M
from quarry.ml import models as MO
from quarry.ml.split import hash_split, label_split
from quarry.ml.store import load_model, stored_fit
from quarry.session import app_path
from quarry.sources.parquet import read_table

# Fixed parameters of the catalogue.
SIZE_SPLITS = [-float("inf"), 10.0, 20.0, 30.0, 40.0, float("inf")]
BALANCE_SPLITS = [-float("inf"), 0.0, 2500.0, 5000.0, 7500.0, float("inf")]
SPLIT_SEED = 4
TRAIN_FRACTION = 0.7
METRIC_DIGITS = 9
SCALE_DIGITS = 6
KEEP_FIT_MAX_SIZE = 2
RICH_BALANCE = 4000.0
FOREST_PARTITIONS = 32  # of the training rows at least; the trees' samples are drawn per partition
SCORE_DIGITS = 2  # the observed sums are whole numbers


def _t(spark, sf_dir, name) -> DataFrame:
    return read_table(spark, sf_dir, name)


def bucketize(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_size")
    return FE.bucketize(p.withColumn("p_size", F.col("p_size").cast("double")), "p_size", "size_bucket", SIZE_SPLITS)


def string_index(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return FE.index_strings(c, c, "c_mktsegment", "seg_idx")


def string_index_keep(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    fit_on = p.filter(F.col("p_size") <= KEEP_FIT_MAX_SIZE)
    out = FE.index_strings(fit_on, p, "p_brand", "brand_idx", keep_unseen=True)
    return out.select("p_partkey", "p_brand", "brand_idx")


def dictionary_index(spark, sf_dir):
    """The indices of ``string_index`` from the distributed dictionary."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    words = D.build_dictionary(c, "c_mktsegment")
    return D.encode(c, "c_mktsegment", words, "seg_idx").withColumn("seg_idx", F.col("seg_idx").cast("double"))


def dictionary_keep(spark, sf_dir):
    """The indices of ``string_index_keep`` from the distributed dictionary."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    words = D.build_dictionary(p.filter(F.col("p_size") <= KEEP_FIT_MAX_SIZE), "p_brand")
    out = D.encode(p, "p_brand", words, "brand_idx", unseen="keep")
    return out.select("p_partkey", "p_brand", F.col("brand_idx").cast("double").alias("brand_idx"))


def dictionary_many(spark, sf_dir):
    """A dictionary of very many values: every order by the rank of its
    customer (as text, by falling number of orders) and by that of its own
    key's text, which no other order has."""
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("customer"), F.col("o_orderkey").cast("string").alias("number")
    )
    out = o
    for column in ("customer", "number"):
        out = D.encode(out, column, D.build_dictionary(o, column), f"{column}_idx")
    return out.select("o_orderkey", "customer_idx", "number_idx")


def one_hot(spark, sf_dir):
    idx = string_index(spark, sf_dir)
    enc = FE.one_hot(idx, "seg_idx", "seg_vec")
    return enc.select("c_custkey", "seg_idx", FE.vector_text("seg_vec").alias("seg_vec"))


def assemble_features(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    v = FE.assemble(p, ["p_size", "p_retailprice"], "features")
    return v.select("p_partkey", *FE.vector_items("features", 2, "f"))


def standard_scale(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    v = FE.standard_scale(FE.assemble(p, ["p_size", "p_retailprice"], "features"), "features", "scaled")
    return v.select("p_partkey", *FE.vector_items("scaled", 2, "s", digits=SCALE_DIGITS))


def scored_orders(spark, sf_dir) -> DataFrame:
    """(label, prediction) pairs derived from orders."""
    o = _t(spark, sf_dir, "orders")
    label = (F.col("o_orderkey") % 3).cast("double")
    pred = F.when(F.col("o_custkey") % 4 == 0, F.lit(0.0)).otherwise(label)
    return o.select("o_orderkey", label.alias("label"), pred.alias("prediction"))


def class_metrics(spark, sf_dir):
    return M.class_metrics(scored_orders(spark, sf_dir), digits=METRIC_DIGITS)


def binary_auc(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    label = (F.col("c_acctbal") > RICH_BALANCE).cast("double")
    score = (F.col("c_custkey") % 50 + F.floor(F.col("c_acctbal") / 500)).cast("double")
    return M.binary_auc(c.select(label.alias("label"), score.alias("score")), digits=METRIC_DIGITS)


def train_test_split(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return label_split(o, ["o_orderkey"], TRAIN_FRACTION, SPLIT_SEED)


def customer_frame(spark, sf_dir) -> DataFrame:
    c = _t(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        "c_acctbal",
        "c_mktsegment",
        F.col("c_nationkey").cast("double").alias("c_nationkey"),
        F.when(F.col("c_acctbal") > RICH_BALANCE, "rich").otherwise("other").alias("tier"),
    )


LOGISTIC_COLUMNS = FE.Columns(
    bucketed={"c_acctbal": BALANCE_SPLITS}, indexed=["c_mktsegment"], plain=["c_nationkey"]
)


def fit_logistic(spark, sf_dir, **options):
    train, _ = hash_split(customer_frame(spark, sf_dir), ["id"], TRAIN_FRACTION, SPLIT_SEED)
    return MO.fit(MO.logistic_pipeline(LOGISTIC_COLUMNS, "tier", **options), train)


def logistic_model(spark, sf_dir):
    """Test-split predictions: id, probability of class 1, prediction."""
    _, test = hash_split(customer_frame(spark, sf_dir), ["id"], TRAIN_FRACTION, SPLIT_SEED)
    preds = fit_logistic(spark, sf_dir).transform(test)
    return preds.select(
        "id", F.get(FE.vector_to_array("probability"), 1).alias("p_1"), "prediction"
    )


def logistic_metrics(spark, sf_dir):
    """Area under ROC (score = probability of class 1, a monotone map of
    the raw margin) and accuracy, on the training split."""
    train, _ = hash_split(customer_frame(spark, sf_dir), ["id"], TRAIN_FRACTION, SPLIT_SEED)
    preds = fit_logistic(spark, sf_dir).transform(train).select(
        "known_label",
        "prediction",
        F.get(FE.vector_to_array("probability"), 1).alias("score"),
    )
    auc = M.binary_auc(preds, "known_label", "score", digits=METRIC_DIGITS)
    acc = M.class_metrics(preds, "known_label", "prediction", digits=METRIC_DIGITS)
    return spark.range(1).select(
        auc.select("auc").scalar().alias("auc"), acc.select("accuracy").scalar().alias("accuracy")
    )


def logistic_score_equations(spark, sf_dir):
    """(feature, predicted): over the training split the sum of each feature
    times the probability of class 1. At the likelihood's maximum it is the
    sum of the feature over the rows of class 1."""
    train, _ = hash_split(customer_frame(spark, sf_dir), ["id"], TRAIN_FRACTION, SPLIT_SEED)
    model = fit_logistic(spark, sf_dir, max_iter=1000, tol=1e-14)
    p = F.get(FE.vector_to_array("probability"), 1)
    x = FE.vector_to_array("features")
    sums = [F.sum(p).alias("intercept")] + [
        F.sum(p * F.get(x, i)).alias(name) for i, name in enumerate(("balance", "segment", "nation"))
    ]
    wide = model.transform(train).agg(*sums)
    return wide.unpivot([], wide.columns, "feature", "predicted").select(
        "feature", F.round("predicted", SCORE_DIGITS).alias("predicted")
    )


def retail_frame(spark, sf_dir) -> DataFrame:
    """Orders with customer attributes; label = priority digit (1..5)."""
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        "o_orderkey",
        "o_orderstatus",
        "c_mktsegment",
        "o_totalprice",
        "c_acctbal",
        F.substring("o_orderpriority", 1, 1).cast("double").alias("rating"),
    ).dropna()


FOREST_CATS = ["o_orderstatus", "c_mktsegment"]
FOREST_NUMS = ["o_totalprice", "c_acctbal"]


FOREST_COLUMNS = FE.Columns(one_hot=FOREST_CATS, scaled=FOREST_NUMS)


def fit_forest(spark, sf_dir):
    """The forest over the training split, from the application's model store:
    fitted and saved where no version has the same stages and data, else loaded."""
    data = retail_frame(spark, sf_dir)
    train, _ = hash_split(data, ["o_orderkey"], TRAIN_FRACTION, SPLIT_SEED)
    pipeline = MO.forest_pipeline(FOREST_COLUMNS, "rating")
    model, _ = stored_fit(
        app_path(spark, "models/forest"), pipeline, train,
        lambda: MO.fit(pipeline, train, keys=["o_orderkey"], partitions=FOREST_PARTITIONS),
    )
    return model


def tree_frame(spark, sf_dir) -> DataFrame:
    """Customers with two numbers and a label that depends on both: whether the
    balance is above a level that differs by nation and by the key's last digit."""
    digit = F.col("c_custkey") % 10
    level = (
        F.when((F.col("c_nationkey") < 12) & (digit < 4), 2000).when(F.col("c_nationkey") < 12, 6500)
        .when(digit < 7, 8000).otherwise(3000)
    )
    return _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("double").alias("nation"),
        digit.cast("double").alias("digit"), (F.col("c_acctbal") > level).cast("double").alias("label"),
    )


TREE_COLUMNS = FE.Columns(plain=["nation", "digit"])


def fit_tree(spark, sf_dir) -> tuple:
    """(model, version, store) of a forest of one tree, two splits deep."""
    train, _ = hash_split(tree_frame(spark, sf_dir), ["id"], TRAIN_FRACTION, SPLIT_SEED)
    pipeline = MO.forest_pipeline(
        TREE_COLUMNS, "label", num_trees=1, max_depth=2, bootstrap=False, feature_subset="all"
    )
    root = app_path(spark, "models/tree")
    model, version = stored_fit(root, pipeline, train, lambda: MO.fit(pipeline, train))
    return model, version, root


def tree_predictions(spark, sf_dir):
    """Test-split predictions of the two-level tree, scored by the model that
    the store gives back: id, label, probability of class 1, prediction."""
    _, version, root = fit_tree(spark, sf_dir)
    _, test = hash_split(tree_frame(spark, sf_dir), ["id"], TRAIN_FRACTION, SPLIT_SEED)
    p = F.get(FE.vector_to_array("probability"), 1)
    return load_model(spark, root, version).transform(test).select(
        "id", "label", F.round(p, METRIC_DIGITS).alias("p_1"), "prediction"
    )


def forest_model(spark, sf_dir):
    model = fit_forest(spark, sf_dir)
    _, test = hash_split(retail_frame(spark, sf_dir), ["o_orderkey"], TRAIN_FRACTION, SPLIT_SEED)
    test = MO.spread(test, ["o_orderkey"], FOREST_PARTITIONS)
    return model.transform(test).select("o_orderkey", "rating", "prediction")


def _forest_predictions(spark, sf_dir) -> DataFrame:
    data = label_split(retail_frame(spark, sf_dir), ["o_orderkey"], TRAIN_FRACTION, SPLIT_SEED)
    # Scoring takes far longer a row than reading: few files must not mean few tasks.
    return fit_forest(spark, sf_dir).transform(MO.spread(data, ["o_orderkey"], FOREST_PARTITIONS))


def forest_metrics(spark, sf_dir):
    """The four weighted metrics on the training split and on the test
    split, one row each, from a single pass of the model over the data."""
    preds = _forest_predictions(spark, sf_dir)
    return M.class_metrics(preds, "rating", "prediction", digits=METRIC_DIGITS, by=["split"])


def forest_label_totals(spark, sf_dir):
    """(split, rating, n, n_known): per split and label the sum of the
    confusion counts, and of those whose prediction is one of the labels."""
    cm = M.confusion(_forest_predictions(spark, sf_dir), "rating", "prediction", by=["split"])
    known = F.sum(F.when(F.col("prediction").isin(1.0, 2.0, 3.0, 4.0, 5.0), F.col("n")).otherwise(0))
    return cm.groupBy("split", F.col("label").alias("rating")).agg(F.sum("n").alias("n"), known.alias("n_known"))


QUERIES = {
    "bucketize": bucketize,
    "string_index": string_index,
    "string_index_keep": string_index_keep,
    "dictionary_index": dictionary_index,
    "dictionary_keep": dictionary_keep,
    "dictionary_many": dictionary_many,
    "one_hot": one_hot,
    "assemble_features": assemble_features,
    "standard_scale": standard_scale,
    "class_metrics": class_metrics,
    "binary_auc": binary_auc,
    "train_test_split": train_test_split,
    "logistic_model": logistic_model,
    "logistic_metrics": logistic_metrics,
    "logistic_score_equations": logistic_score_equations,
    "forest_model": forest_model,
    "forest_metrics": forest_metrics,
    "forest_label_totals": forest_label_totals,
    "tree_predictions": tree_predictions,
}

_CM = """
WITH p AS (
  SELECT CAST(o_orderkey % 3 AS DOUBLE) AS label,
         CASE WHEN o_custkey % 4 = 0 THEN 0.0 ELSE CAST(o_orderkey % 3 AS DOUBLE) END AS prediction
  FROM orders
),
lab AS (SELECT label AS c, COUNT(*) AS n_c,
               SUM(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS tp FROM p GROUP BY label),
pr AS (SELECT prediction AS c, COUNT(*) AS n_p FROM p GROUP BY prediction),
per AS (
  SELECT n_c, tp, CASE WHEN COALESCE(n_p, 0) = 0 THEN 0.0 ELSE tp / n_p END AS prec,
         tp / n_c AS rec
  FROM lab LEFT JOIN pr ON lab.c = pr.c
),
f AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1
      FROM per)
SELECT ROUND(SUM(tp) / SUM(n_c), 9) AS accuracy,
       ROUND(SUM(n_c * prec) / SUM(n_c), 9) AS weighted_precision,
       ROUND(SUM(n_c * rec) / SUM(n_c), 9) AS weighted_recall,
       ROUND(SUM(n_c * f1) / SUM(n_c), 9) AS weighted_f1
FROM f
"""


def _sql_bucket(key: str) -> str:
    return f"('0x' || SUBSTR(MD5({key}::VARCHAR || '|4'), 1, 8))::BIGINT % 10000"


_TIERS = f"""
t AS (
  SELECT *, CASE WHEN c_acctbal > 4000 THEN 'rich' ELSE 'other' END AS tier,
         CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 2500 THEN 1 WHEN c_acctbal < 5000 THEN 2
              WHEN c_acctbal < 7500 THEN 3 ELSE 4 END AS bucket
  FROM customer WHERE {_sql_bucket("c_custkey")} < 7000),
seg AS (SELECT c_mktsegment, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) - 1 AS i FROM t GROUP BY 1),
lab AS (SELECT tier, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, tier) - 1 AS y FROM t GROUP BY 1)
"""
ORACLE_SQL = {
    "train_test_split": (
        f"SELECT o_orderkey, o_custkey, CASE WHEN {_sql_bucket('o_orderkey')} < 7000 "
        "THEN 'train' ELSE 'test' END AS split FROM orders"
    ),
    "logistic_score_equations": (
        f"WITH {_TIERS}, x AS (SELECT t.*, i, y FROM t JOIN seg USING (c_mktsegment) JOIN lab USING (tier)) "
        "SELECT 'intercept' AS feature, SUM(y)::DOUBLE AS predicted FROM x "
        "UNION ALL SELECT 'balance', SUM(y * bucket)::DOUBLE FROM x "
        "UNION ALL SELECT 'segment', SUM(y * i)::DOUBLE FROM x "
        "UNION ALL SELECT 'nation', SUM(y * c_nationkey)::DOUBLE FROM x"
    ),
    "forest_label_totals": (
        f"SELECT CASE WHEN {_sql_bucket('o_orderkey')} < 7000 THEN 'train' ELSE 'test' END AS split, "
        "SUBSTR(o_orderpriority, 1, 1)::DOUBLE AS rating, COUNT(*) AS n, COUNT(*) AS n_known "
        "FROM orders JOIN customer ON o_custkey = c_custkey "
        "WHERE o_orderkey IS NOT NULL AND o_orderstatus IS NOT NULL AND c_mktsegment IS NOT NULL "
        "AND o_totalprice IS NOT NULL AND c_acctbal IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY ALL"
    ),
    "bucketize": (
        "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CAST(CASE WHEN p_size < 10 THEN 0 "
        "WHEN p_size < 20 THEN 1 WHEN p_size < 30 THEN 2 WHEN p_size < 40 THEN 3 ELSE 4 END "
        "AS DOUBLE) AS size_bucket FROM part"
    ),
    "string_index": (
        "WITH f AS (SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1), "
        "ix AS (SELECT c_mktsegment, ROW_NUMBER() OVER (ORDER BY n DESC, c_mktsegment) - 1 "
        "AS idx FROM f) SELECT c.c_custkey, c.c_mktsegment, CAST(ix.idx AS DOUBLE) AS seg_idx "
        "FROM customer c JOIN ix USING (c_mktsegment)"
    ),
    "string_index_keep": (
        "WITH f AS (SELECT p_brand, COUNT(*) AS n FROM part WHERE p_size <= 2 GROUP BY 1), "
        "ix AS (SELECT p_brand, ROW_NUMBER() OVER (ORDER BY n DESC, p_brand) - 1 AS idx FROM f) "
        "SELECT p.p_partkey, p.p_brand, CAST(COALESCE(ix.idx, (SELECT COUNT(*) FROM f)) AS DOUBLE) "
        "AS brand_idx FROM part p LEFT JOIN ix USING (p_brand)"
    ),
    "one_hot": (
        "WITH f AS (SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1), "
        "ix AS (SELECT c_mktsegment, ROW_NUMBER() OVER (ORDER BY n DESC, c_mktsegment) - 1 "
        "AS idx FROM f), k AS (SELECT COUNT(*) - 1 AS w FROM f) "
        "SELECT c.c_custkey, CAST(ix.idx AS DOUBLE) AS seg_idx, "
        "CASE WHEN ix.idx < (SELECT w FROM k) THEN REPEAT('0,', CAST(ix.idx AS INTEGER)) || '1' "
        "|| REPEAT(',0', CAST((SELECT w FROM k) - ix.idx - 1 AS INTEGER)) "
        "ELSE SUBSTR(REPEAT('0,', CAST((SELECT w FROM k) AS INTEGER)), 1, "
        "CAST(2 * (SELECT w FROM k) - 1 AS INTEGER)) END AS seg_vec "
        "FROM customer c JOIN ix USING (c_mktsegment)"
    ),
    "assemble_features": (
        "SELECT p_partkey, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1 FROM part"
    ),
    "standard_scale": (
        "SELECT p_partkey, ROUND(p_size / STDDEV_SAMP(p_size) OVER (), 6) AS s0, "
        "ROUND(p_retailprice / STDDEV_SAMP(p_retailprice) OVER (), 6) AS s1 FROM part"
    ),
    "class_metrics": _CM,
    "binary_auc": (
        "WITH s AS (SELECT CASE WHEN c_acctbal > 4000 THEN 1 ELSE 0 END AS label, "
        "CAST((c_custkey % 50) + FLOOR(c_acctbal / 500) AS DOUBLE) AS score FROM customer), "
        "g AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM s GROUP BY score), "
        "c AS (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED "
        "PRECEDING AND 1 PRECEDING), 0) AS below FROM g) "
        "SELECT ROUND(SUM(pos * (below + 0.5 * neg)) / ((SELECT SUM(pos) FROM g) * "
        "(SELECT SUM(neg) FROM g)), 9) AS auc FROM c"
    ),
}
ORACLE_SQL["dictionary_index"] = ORACLE_SQL["string_index"]
ORACLE_SQL["dictionary_keep"] = ORACLE_SQL["string_index_keep"]
ORACLE_SQL["dictionary_many"] = (
    "WITH f AS (SELECT o_custkey::VARCHAR AS v, COUNT(*) AS n FROM orders GROUP BY 1), "
    "ix AS (SELECT v, ROW_NUMBER() OVER (ORDER BY n DESC, v) - 1 AS i FROM f) "
    "SELECT o_orderkey, i AS customer_idx, ROW_NUMBER() OVER (ORDER BY o_orderkey::VARCHAR) - 1 AS number_idx "
    "FROM orders JOIN ix ON o_custkey::VARCHAR = v"
)


def _splits(level: int, rows: str) -> str:
    """CTEs that split every node of ``rows`` (node, label, nation, digit) at
    the threshold of least Gini impurity, as midpoints' left values."""
    return f"""
long{level} AS (
  SELECT node, label, 0 AS f, nation AS x FROM {rows} UNION ALL SELECT node, label, 1, digit FROM {rows}),
sums{level} AS (
  SELECT node, f, x, SUM(COUNT(*)) OVER (PARTITION BY node, f ORDER BY x)::DOUBLE AS n, SUM(SUM(label)) OVER (PARTITION BY node, f ORDER BY x) AS p,
    SUM(COUNT(*)) OVER (PARTITION BY node, f)::DOUBLE AS tn, SUM(SUM(label)) OVER (PARTITION BY node, f) AS tp
  FROM long{level} GROUP BY node, f, x),
best{level} AS (
  SELECT node, f, x FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY node ORDER BY (p * p + (n - p) * (n - p)) / n
      + ((tp - p) * (tp - p) + (tn - n - tp + p) * (tn - n - tp + p)) / (tn - n) DESC, f, x) AS r
    FROM sums{level} WHERE n < tn) WHERE r = 1)"""


# The two levels of best splits over the training rows. Two leaves of one
# parent that predict the same class are one leaf in MLlib, at both levels.
TREE_SQL = f"""
WITH t AS (
  SELECT c_custkey AS id, c_nationkey::DOUBLE AS nation, (c_custkey % 10)::DOUBLE AS digit,
    CASE WHEN c_acctbal > CASE WHEN c_nationkey < 12 AND c_custkey % 10 < 4 THEN 2000 WHEN c_nationkey < 12 THEN 6500
                               WHEN c_custkey % 10 < 7 THEN 8000 ELSE 3000 END THEN 1.0 ELSE 0.0 END AS label,
    {_sql_bucket("c_custkey")} < 7000 AS train
  FROM customer),
n0 AS (SELECT *, 0 AS node FROM t WHERE train), {_splits(1, "n0")},
n1 AS (
  SELECT t.id, t.nation, t.digit, t.label, t.train, CASE WHEN (CASE f WHEN 0 THEN nation ELSE digit END) <= b.x THEN 0 ELSE 1 END AS node
  FROM t, best1 b),
n1_train AS (SELECT * FROM n1 WHERE train), {_splits(2, "n1_train")},
n2 AS (
  SELECT n1.*, CASE WHEN (CASE f WHEN 0 THEN nation ELSE digit END) <= b.x THEN 0 ELSE 1 END AS side
  FROM n1 JOIN best2 b USING (node)),
leaf AS (SELECT node, side, AVG(label) AS p FROM n2 WHERE train GROUP BY node, side),
inner_ AS (
  SELECT n.node, n.p, l.same FROM (SELECT node, AVG(label) AS p FROM n2 WHERE train GROUP BY node) n
  JOIN (SELECT node, COUNT(DISTINCT p > 0.5) = 1 AS same FROM leaf GROUP BY node) l USING (node)),
top AS (
  SELECT (SELECT AVG(label) FROM n2 WHERE train) AS p, BOOL_AND(same) AND COUNT(DISTINCT p > 0.5) = 1 AS one FROM inner_),
scored AS (
  SELECT id, label, CASE WHEN one THEN t.p WHEN same THEN i.p ELSE l.p END AS p
  FROM n2 JOIN leaf l USING (node, side) JOIN inner_ i USING (node), top t WHERE NOT train)"""
ORACLE_SQL["tree_predictions"] = (
    f"{TREE_SQL} SELECT id, label, ROUND(p, 9) AS p_1, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM scored"
)
