"""A corpus pipeline: quality, exact and near duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loamframe.llm.exact import drop_exact_duplicates
from loamframe.llm.jaccard import keep_one_of_each
from loamframe.llm.packing import pack_documents
from loamframe.llm.quality import keep_good
from loamframe.llm.shared import discard, materialise
from loamframe.llm.substrings import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts and null ids are scored like others, very long texts whole;
    repeated rows are judged alike; an empty table stays empty; all columns of
    ``docs`` come along, whatever they are called.
    """
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id.

    Null counts as an empty text and a null id ranks below all; of repeated rows one
    stays; an empty table stays empty; all columns come along.
    """
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id.

    Null, empty and blank texts are near to nothing and all stay; a null id ranks
    last; of repeated rows one stays; an empty table stays empty; all columns come along.
    """
    return keep_one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id also has.

    All rows stay, null and empty texts as they are; rows with a null id count as
    last; rows with one id do not count against each other; an empty table stays
    empty; all columns come along and ``n_chars`` follows the text.
    """
    return without_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 4096 tokens.

    Null and empty texts hold the end token alone; null ids and repeated rows are
    documents like any other; long texts give several pieces; an empty table gives none.
    """
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096, special=True)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("repeats", repeats), ("packing", packing)]

#: The classifier and the packing have no SQL form; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        last, docs = docs, materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, last)
    return docs
