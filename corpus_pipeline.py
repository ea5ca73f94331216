"""The corpus pipeline: documents to a clean, mixed, tokenised training set.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes every stage's result as
Parquet to the shared folder and gives it to the next stage as its docs, so a lost executor
never reaches back over a stage. All stages but the last return the columns of documents;
a stage works on all rows that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keelson.llm.common import dropped, read, stored
from keelson.llm.decontaminate import clean_documents
from keelson.llm.jaccard import one_of_each
from keelson.llm.mixing import mixed_documents
from keelson.llm.quality_crf import good_documents
from keelson.llm.tokens import encode_corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier does not reject."""
    return good_documents(docs.select(*COLUMNS), read(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least doc_id, of each group of near duplicates."""
    return one_of_each(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs.select(*COLUMNS), read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs.select(*COLUMNS))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the token shards."""
    return encode_corpus(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# A trained model and a set of iterative solutions: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        dropped(before)
    return docs
