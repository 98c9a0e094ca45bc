"""Update-mode output into a table: a keyed upsert on plain Parquet.

A batch's rows (the new values of the keys that changed) go to a folder of
their own, ``batch=<id>``, split into buckets by a hash of the key. The current
value of a key is that of its latest batch. A replayed batch overwrites its
folder, so it changes nothing; a batch that died half-way has no ``_SUCCESS``
and isn't read.

Every ``compact_every`` batches the batches so far are merged into
``base=<id>``, the latest row per key; readers take the last whole base and the
batches after it. The bases before the last one and the batches they hold are
removed after the next merge, so a reader that has just listed the folder
still finds its files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.session import child_names, delete_path

BUCKET = "upsert_bucket"
STAMP = "upsert_batch"


class UpsertTable:
    """A table of ``schema`` under ``path`` with one row per ``keys``."""

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType,
        buckets: int = 16, compact_every: int = 8,
    ):
        missing = [k for k in keys if k not in schema.names]
        clash = [n for n in schema.names if n in (BUCKET, STAMP)]
        if missing or clash or not keys:
            raise ValueError(f"keys must be columns of the table, and {BUCKET} and {STAMP} must not: {missing or clash}")
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema
        self.buckets, self.compact_every = buckets, compact_every

    def _whole(self, kind: str) -> list[int]:
        names = child_names(self.spark, f"{self.path}/{kind}=*/_SUCCESS", up=1)
        return sorted(int(n.split("=")[1]) for n in names)

    def _read(self, kind: str, number: int) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(BUCKET, "integer").add(STAMP, "long")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}={number}")

    def _write(self, df: DataFrame, kind: str, number: int) -> None:
        """Few files: a bucket's rows come together before they are written."""
        df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{kind}={number}")

    def _parts(self) -> list[DataFrame]:
        bases = self._whole("base")
        last = bases[-1] if bases else -1
        parts = [self._read("base", last)] if bases else []
        return parts + [self._read("batch", b) for b in self._whole("batch") if b > last]

    def _latest(self, parts: list[DataFrame]) -> DataFrame:
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        row = F.struct(*self.schema.names)
        best = rows.groupBy(BUCKET, *[F.col(k).alias(f"key_{i}") for i, k in enumerate(self.keys)]).agg(
            F.max_by(row, STAMP).alias("row"), F.max(STAMP).alias(STAMP)
        )
        return best.select("row.*", BUCKET, STAMP)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one batch; usable as a ``foreachBatch`` function. A batch
        that runs again writes the same folder, and the same base if it ends a
        round of batches."""
        place = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        rows = batch.select(*self.schema.names).withColumn(BUCKET, place).withColumn(STAMP, F.lit(batch_id).cast("long"))
        self._write(rows, "batch", batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def compact(self, upto: int) -> None:
        """Merge everything up to batch ``upto`` into a base."""
        old = [b for b in self._whole("base") if b < upto]
        parts = ([self._read("base", old[-1])] if old else []) + [
            self._read("batch", b) for b in self._whole("batch") if (old[-1] if old else -1) < b <= upto
        ]
        if not parts:
            return
        self._write(self._latest(parts), "base", upto)
        if old:
            for b in self._whole("batch"):
                if b <= old[-1]:
                    delete_path(self.spark, f"{self.path}/batch={b}")
            for b in old[:-1]:
                delete_path(self.spark, f"{self.path}/base={b}")

    def read(self) -> DataFrame:
        """The current rows, one per key."""
        parts = self._parts()
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self._latest(parts).select(*self.schema.names)


def upsert_sink(
    spark: SparkSession, path: str, keys: Sequence[str], flatten: Callable[[DataFrame], DataFrame], schema: StructType, **options
) -> tuple[UpsertTable, Callable[[DataFrame, int], None]]:
    """The table and its ``foreachBatch`` function; ``flatten`` maps a batch to
    the table's columns."""
    table = UpsertTable(spark, path, keys, schema, **options)
    return table, lambda batch, batch_id: table.apply(flatten(batch), batch_id)
