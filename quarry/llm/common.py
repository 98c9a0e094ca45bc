"""Helpers shared by the training-data operators: column expressions, keyed
prefix sums and storage under the cluster's shared folder."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: The contract's white space and word classes.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """All columns as one struct ``row``, so that no working column can meet
    the name of one of them, and ``more``."""
    columns = [F.col(f"`{n.replace('`', '``')}`") for n in df.columns]
    return df.select(F.struct(*columns).alias("row"), *[c.alias(n) for n, c in more.items()])


def unpacked(df: DataFrame, names: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row`` again, those of ``changed`` with new values. These
    are computed first: in one select, names inside lambdas would mean the
    select's own columns."""
    new = {n: f"changed_{i}" for i, n in enumerate(changed)}
    if new:
        df = df.withColumns({new[n]: c for n, c in changed.items()})
    return df.select(*[(F.col(new[n]) if n in new else F.col("row").getField(n)).alias(n) for n in names])


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, where all executors see
    it (a private one only where the setting is missing, in local mode), with
    its file system: a path without scheme lies in Spark's default one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"llm-{name}"))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: it
    is computed once and survives lost executors."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{SPACE}]++")), F.lit(0)).cast("long")


def hash_unit(*cols: Column) -> Column:
    """60 bits of md5 over the joined columns, as a long: an order that any
    engine can compute."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("long")
