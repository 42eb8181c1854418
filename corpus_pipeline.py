"""From raw documents to shards of a training mix, in five stages.

All stages take rows with NULL in any column, empty and very long texts, repeated rows, and tables without rows; columns of any
name stay as they are. Ties are decided by doc_id or by hashes of the rows, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from funnelwright.llm.common import Scratch, read_documents
from funnelwright.llm.decontam import drop_leaks
from funnelwright.llm.langid import keep_languages
from funnelwright.llm.mixing import mix
from funnelwright.llm.neardup import drop_near_duplicates
from funnelwright.llm.sharding import shard_documents


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has enough of to know it; the declared one and the source's prior help.

    NULL, empty and letterless texts go, and texts unlike all known languages. Repeated rows are judged alike. Where no language is
    known (no labels, or next to no text), every text with a letter stays.
    """
    return keep_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id: shingles of five words, similarity of 0.8.

    NULL and empty texts are like nothing and stay, as do rows without doc_id. Rows that share a kept doc_id all stay.
    """
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    NULL and empty texts have none. Rows that share a doc_id go together; rows without one are judged by their text. Benchmark items
    that are NULL, empty or of fewer than four words are not looked for.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their weights: documents as often as the mix takes them.

    A NULL source is a source of its own. Texts without words come as often as the complete epochs of their source. Equal rows are
    taken together.
    """
    return mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in 40 shards of nearly equal bytes, with the column ``shard``.

    A NULL text has no bytes of its own. Rows that agree in text and doc_id are in one shard.
    """
    return shard_documents(docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mix", mixed),
    ("shards", sharded),
]

# Trained likelihoods and searched boundaries are beyond SQL; the tests compare the rows of each stage with a plain recomputation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is a table in the shared folder before the next stage reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = read_documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"stage-{number}")
        if number:
            scratch.drop(f"stage-{number - 1}")
    return docs
