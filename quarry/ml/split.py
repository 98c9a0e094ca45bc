"""Reproducible train/test split by a hash of a key.

``randomSplit`` with a fixed seed still depends on how the input is
partitioned and ordered; a hash of a key column does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_bucket(keys: Sequence[str], seed: int, buckets: int = 10000) -> Column:
    """A bucket from the first eight hex digits of an md5 over the keys and the
    seed, which other engines can compute as well. A null key counts as ''."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    train_fraction: float = 0.7,
    seed: int = 4,
    buckets: int = 10000,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): a row is in train when its key hashes below
    ``train_fraction`` of the buckets. Same rows whatever the partitioning."""
    cut = int(round(train_fraction * buckets))
    b = split_bucket(keys, seed, buckets)
    return df.filter(b < cut), df.filter(b >= cut)


def label_split(
    df: DataFrame,
    keys: Sequence[str],
    train_fraction: float = 0.7,
    seed: int = 4,
    buckets: int = 10000,
    alias: str = "split",
) -> DataFrame:
    """``df`` with a ``split`` column ("train"/"test") instead of two frames."""
    cut = int(round(train_fraction * buckets))
    b = split_bucket(keys, seed, buckets)
    return df.withColumn(alias, F.when(b < cut, "train").otherwise("test"))
