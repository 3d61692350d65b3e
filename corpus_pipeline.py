"""Corpus pipeline: quality, near duplicates, repeated passages, mixture, token ids.

``STAGES`` are (name, function); a function takes the session, the documents its
predecessor kept and the folder of the tables.  Every stage is written
as Parquet and read again before the next.  A stage handles what its operator
does: NULL and empty texts, repeated rows, empty tables; columns beyond those
of ``documents`` are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runlens.llm import pieces
from runlens.llm.compact_windows import remove_repeats, repeated_passages
from runlens.llm.mixing import Target, mix
from runlens.llm.site_quality import classify
from runlens.llm.weighted_minhash import keep_one
from runlens.plans.tables import write_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Passes over the smallest source for one over the largest; every document is used at least once.
MIX = Target(max_repetition=2.0)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of text, host and path keeps; empty texts are judged like any."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = classify(docs, labels, F.col("source"), F.concat_ws("/", "source", "lang"), COLUMNS)
    return judged.where("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of smallest doc_id."""
    return keep_one(docs.select(COLUMNS))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document of smaller doc_id has; a text of which nothing is left goes."""
    docs = docs.select(COLUMNS)
    return remove_repeats(docs, write_table(repeated_passages(docs), "passages"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for: at least once, with one row for each copy."""
    return mix(docs.select(COLUMNS), MIX).select(COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    return pieces.encode(docs, ["doc_id", "lang", "source"]).select("row.*", "n_pieces", "n_byte_pieces", "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeats", repeats),
          ("mixture", mixture), ("encoding", encoding)]

# The classifier and the hashed operators have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
