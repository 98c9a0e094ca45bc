"""A corpus pipeline over the tables of one folder.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages
but the last return the columns of ``documents``; the last returns the packed
pieces. A stage works on everything that the stage before it kept.

Defined cases: a null text is an empty one to every stage (it stays null until
the mix, which takes no row without words). Empty and blank texts have no toxic
feature beyond the classifier's bias, link with nothing, hold no secret, and go
in the mix. Rows with a null doc_id are documents like others, repeated rows
near-copies of each other. Ties: a score at the threshold is toxic, of equal
doc_ids the row read first stays, equal rows are interchangeable in the mix. An
empty table gives an empty result. Columns beside doc_id, text, source, n_chars
pass through, whatever their names. Texts of any length are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import mixing, ngram_join, packing, secrets, toxicity
from quarry.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return ngram_join.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; ``n_chars`` counts the new ones."""
    kind = docs.schema["n_chars"].dataType
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out to their sources' targets."""
    return mixing.repeat_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither a trained classifier nor a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
