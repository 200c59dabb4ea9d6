"""The corpus pipeline: language, near duplicates, benchmark passages, tokens.

``run(spark, sf_dir)`` applies ``STAGES`` to the documents in order. Each stage takes
``(spark, docs, sf_dir)`` and returns a table, which is written to the shared folder and
read back as the next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.llm import language_id
from hexloom.llm.bpe import encode_and_decode
from hexloom.llm.common import table, written
from hexloom.llm.decontaminate import clean
from hexloom.llm.near_duplicates import one_of_each_class
from hexloom.llm.queries import vocabulary_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; texts that are null or hold no letter go.

    The field is learned from the text and non-null lang of the documents it is given.
    """
    found = language_id.predict(docs, language_id.train(docs))
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one document, that with the smallest doc_id, null ones last.

    Documents are told apart by doc_id and text: two texts under one doc_id stay or go each
    by its own class, and of rows equal in both one stays. Documents without words all stay.
    """
    return one_of_each_class(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, as it is or re-parameterised; those without a doc_id or text too."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    return encode_and_decode(docs.select("doc_id", "text"), vocabulary_path()).drop("text")


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_benchmark),
    ("BPE encoding and decoding", tokens),
]
#: SQL expresses neither a learned field nor min-hashes; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on all that the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
