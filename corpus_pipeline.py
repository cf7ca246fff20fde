"""A corpus pipeline of five stages over the documents of a data directory.

Each stage is a function of (spark, docs, sf_dir) that returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fernwell.llm import decontaminate, jaccard, packing, pii, quality
from fernwell.llm.queries import tokenizer_file
from fernwell.llm.shared import stash, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, rows without an id or with a repeated
    one, and empty ones, by their own text."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id, whatever the ids:
    rows without an id and rows that share one are decided on their own. Documents without words
    are linked with nothing, and stay; of equal rows one stays."""
    return jaccard.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; those without text hold none. Rows that share an id
    (or have none) go if one of them holds an item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks; a null text stays null."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences; a null or empty text is its end id alone."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stash(stage(spark, docs, sf_dir), f"stage{k}")
    return docs


#: No SQL: classifier, tokenizer and dynamic programming are not expressible in it.
ORACLE_SQL = None
