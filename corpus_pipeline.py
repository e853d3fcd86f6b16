"""The training-data pipeline: five stages, each written as Parquet and read by the next.

Every stage takes tables of any size, empty ones included, with columns besides those of documents; the
first four pass them on, the last one gives the columns of documents, the number of tokens and their ids.
Each bounds what Spark hands to Python at once, unless the session has a bound of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.llm import bpe, decontaminate, language_id, line_dedup
from siftrail.llm.common import written
from siftrail.llm.near_copies import keep_first
from siftrail.llm.queries import settle, word_vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with that language; the others go.

    Null texts and texts without a letter go, also very long ones; ties go to the language that sorts first.
    Repeated rows are judged one by one. Nothing is left of a table without labelled rows.
    """
    settle(spark)
    return language_id.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its source's boilerplate lines, its length counted anew.

    Null texts stay, with a null length; so do rows without a source and texts that lose all their lines.
    """
    settle(spark)
    kept = line_dedup.drop_boilerplate(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    The smallest id stays; null ids come last, and among rows of one id the row's hash decides. Null and
    empty texts are one group.
    """
    settle(spark)
    return keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Null texts contain none, and an empty benchmark has none."""
    settle(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents with their token ids; null texts have none. Very long texts are encoded whole."""
    settle(spark)
    coded = bpe.encode_decode(docs, word_vocabulary)
    return coded.select("doc_id", "lang", "source", "text", "n_chars", "n_tokens", "ids")


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontamination", benchmark),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Language scores and fingerprints are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None
