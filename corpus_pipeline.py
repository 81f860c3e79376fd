"""The corpus pipeline: quality, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tesserae.llm.common import staged, table
from tesserae.llm.exact_dedup import exact_dedup
from tesserae.llm.mixing import mix
from tesserae.llm.packing import pack
from tesserae.llm.quality import keep_quality, train
from tesserae.llm.simhash import near_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below 0.5 go.

    Null texts are scored as empty ones; repeated rows go or stay together; an empty table, or no labels, keeps all.
    """
    return keep_quality(docs, train(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays, one row of it.

    Null and empty texts are one group; a null doc_id ranks lowest; rows that share a doc_id are told apart by a hash.
    """
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their SimHash fingerprints the document with the smallest doc_id stays, one row of it.

    Texts without words are one group; a null doc_id comes last; rows that share a doc_id are told apart by a hash.
    """
    return near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, none more than three times, shuffled over the shards.

    Texts without words are never drawn; a null source is one of its own; rows are drawn each by itself, whatever their
    doc_id. One row per source is cut, so that the source's words are its target.
    """
    return mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens: every row that is left, repeats too, a null text as its end id alone."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mixed), ("pack", packed)]

#: SQL can't express the classifier, the fingerprints and the packing; tests/llm/test_pipeline.py holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
