"""A dictionary encoder that stays distributed.

``StringIndexer`` brings every label to the driver. Here the labels are a
table: counted with map-side sums, range-sorted by (count desc, value), and
numbered by their partition's offset plus their place in it. Encoding joins
the table back. The ranks are those of ``StringIndexer``'s ``frequencyDesc``
order (ties alphabetical), so the two are interchangeable.

Values with more rows than an even partition (at most one per partition, so a
bounded table) are salted in the join by a hash of the row; AQE's skew join is
a second line for rows that are equal as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.skew import hot_slices
from quarry.session import cut_lineage

#: monotonically_increasing_id() keeps the partition above this many bits.
_ROW_BITS = 33


@dataclass(frozen=True)
class Dictionary:
    """``table`` (value, index, n): one row per distinct value, ``index`` from
    0 in the order of falling count ``n``, then value; ``size`` rows."""

    table: DataFrame
    size: int

    @property
    def values(self) -> DataFrame:
        return self.table.select("value", "index")


def build_dictionary(df: DataFrame, column: str, path: str | None = None) -> Dictionary:
    """Count and rank the distinct values of ``column`` (nulls are no value).
    With ``path`` the table is kept there, for :func:`load_dictionary`."""
    counts = (
        df.select(F.col(column).alias("value")).where("value IS NOT NULL")
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    order = (F.col("n").desc(), F.col("value").asc())
    lined = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id's upper part is the partition, its lower part the place in it;
    # written at once, so that both are read back as they were.
    at = F.monotonically_increasing_id()
    placed = cut_lineage(
        lined.select("value", "n", F.shiftright(at, _ROW_BITS).alias("part"), at.bitwiseAND((1 << _ROW_BITS) - 1).alias("place")),
        "dictionary-ranges",
    )
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("start"))
    ranked = placed.join(F.broadcast(offsets), "part").select(
        "value", (F.col("start") + F.col("place")).alias("index"), "n"
    )
    table = cut_lineage(ranked, "dictionary", path)
    return Dictionary(table, table.count())


def load_dictionary(spark, path: str) -> Dictionary:
    table = spark.read.parquet(path)
    return Dictionary(table, table.count())


def _unknown(dictionary: Dictionary, found: Column, value: Column, unseen: str) -> Column:
    if unseen == "keep":
        return F.coalesce(found, F.lit(dictionary.size))
    message = F.concat(F.lit("value that is not in the dictionary: "), F.coalesce(value.cast("string"), F.lit("null")))
    return F.coalesce(found, F.raise_error(message).cast("long"))


def encode(df: DataFrame, column: str, dictionary: Dictionary, output: str, unseen: str = "error") -> DataFrame:
    """``df`` with the index (long) of ``column`` as ``output``. A value that
    the dictionary doesn't know, null included, raises (``error``), takes the
    index ``size`` (``keep``) or its row goes (``skip``)."""
    if unseen not in ("error", "keep", "skip"):
        raise ValueError(f"unseen must be error, keep or skip, not {unseen!r}")
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    # All columns of the caller travel as one, so no name can clash.
    rows = df.select(F.struct(*[F.col(c) for c in names]).alias("row"), F.col(column).alias("key"))
    rows = rows.withColumn("spot", F.xxhash64("row"))
    hot = hot_slices(rows.select("key").where("key IS NOT NULL"), "key", parts)
    large = hot.spread(rows, "spot")
    small = hot.repeat(dictionary.values.withColumnRenamed("value", "key"))
    how = "inner" if unseen == "skip" else "left"
    joined = large.join(small.withColumnRenamed("index", "found"), ["key", "salt"], how)
    index = F.col("found") if unseen == "skip" else _unknown(dictionary, F.col("found"), F.col("key"), unseen)
    return joined.select("row.*", index.alias(output))


def decode(df: DataFrame, column: str, dictionary: Dictionary, output: str) -> DataFrame:
    """The values behind the indices of ``column`` (null where there is none)."""
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(column).cast("long").alias("key"))
    table = dictionary.table.select(F.col("index").alias("key"), "value")
    return rows.join(table, "key", "left").select("row.*", F.col("value").alias(output))
