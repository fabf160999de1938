"""From raw documents to token ids in five stages, each a step over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulltime.llm import fertility, jaccard_join, pieces, pii_boost, source_mix
from fulltime.llm.common import shared_path, table

#: Rows hang on seeded draws, a fitted detector and public vocabularies: SQL can't express them.
ORACLE_SQL = None

PIECES = "piece_bpe_32k.model"


def _small_batches(spark: SparkSession) -> None:
    """Rows are whole texts: batches to Python workers hold fewer of them than the session's default."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility bands keep."""
    _small_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    judged = fertility.verdict(rows, public_tokenizers.path(PIECES), keep=["row"])
    return judged.where("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose 5-word shingles have a Jaccard similarity of 0.75 or more."""
    return jaccard_join.one_of_each_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii_boost.redact(docs, pii_boost.fit(docs.select("text")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed at weights 5, 2, 1: a row for each time a document is taken, whole or the parts taken."""
    _small_batches(spark)
    return source_mix.mix(docs).texts()


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their digest, and that of the text decoded from them."""
    _small_batches(spark)
    return pieces.round_trip(docs, public_tokenizers.path(PIECES), with_ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
