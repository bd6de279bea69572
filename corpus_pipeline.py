"""The corpus pipeline: stages over documents, each on all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkeeper.llm import bpe, leaks, lines, simhash, toxicity
from loadkeeper.llm.queries import tokenizer
from loadkeeper.llm.shared import bounded_batches, cut, table

#: The toxicity score from which a document goes: likelier toxic than not.
REJECTED = 0.5


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose toxicity score reaches REJECTED."""
    bounded_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.withColumn("_score", toxicity.score(F.col("text"), model)).filter(F.col("_score") < REJECTED).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are near duplicates the first stays; n_chars follows the text. Documents left without lines go."""
    bounded_batches(spark)
    kept = lines.dedup(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    bounded_batches(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold a benchmark item."""
    return leaks.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids of every document and the text they stand for."""
    bounded_batches(spark)
    path, pattern = tokenizer()
    # ids are written before they are decoded: a task then has one Python worker at a time, not one for either step
    coded = cut(docs.select("doc_id", bpe.encode(F.col("text"), path, pattern).alias("ids")))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", bpe.decode(F.col("ids"), path).cast("string").alias("decoded"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
#: The stages learn from labels, hash, and compare sets of lines and words: beyond SQL. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
