"""File stream sources with explicit schemas and bounded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def parquet_stream(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    max_files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Parquet files of ``directory`` as a stream (schema borrowed from a
    batch DataFrame, e.g. ``df.schema``). ``glob`` narrows the files; a
    stream source needs a directory, not a single file."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(directory)


def csv_stream(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    header: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Headerless (by default) CSV files of ``directory`` as a stream."""
    r = spark.readStream.schema(schema).option("header", str(header).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.csv(directory)


def text_stream(
    spark: SparkSession, directory: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.load(directory)
