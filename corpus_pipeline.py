"""Stages that turn raw documents into packed training sequences.

Each stage works on all that its predecessor kept. The models of the first two are fitted on the
labelled rows of the documents that the stage is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lychgate.llm import near_dup, packing, passages, quality, toxicity
from lychgate.llm.common import docs_of, written


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those predicted to be toxic.

    Rows are judged one by one, equal texts alike; null and empty texts have no hits and stay; texts count whole; rows that
    share a doc_id or have none are kept or not by their texts; an empty table stays empty; all columns stay as they are,
    whatever their names."""
    return toxicity.accept(docs, toxicity.train(spark, docs, sf_dir))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those predicted to be of low quality.

    As the stage before: by row, null texts count as empty and are judged by the features of an empty text, texts count
    whole, repeated or missing ids make no difference, empty tables and other columns stay."""
    return quality.accept(docs, quality.train(spark, docs, sf_dir))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each near-duplicate group.

    Texts without words are near nothing and stay; of rows that share a doc_id the one with the least text stays; rows
    without doc_id stay all; an empty table stays empty; other columns stay as they are."""
    return near_dup.one_of_each(docs)


def stage_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a document of smaller id has.

    Null, empty and short texts and rows without doc_id stay as they are; a document of which no word is left goes; rows
    that share a doc_id are one document; n_chars is counted anew where a text was cut; an empty table stays empty;
    other columns stay as they are."""
    return passages.without_repeats(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences.

    Null and empty texts are one piece with the closing id alone; texts of any length are cut without loss; rows that share
    a doc_id or have none are each packed; an empty table gives no pieces; other columns are not read."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", stage_toxicity),
    ("quality", stage_quality),
    ("near_dedup", stage_near_dedup),
    ("passages", stage_passages),
    ("packing", stage_packing),
]

#: The stages score with fitted models and tokenize, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
