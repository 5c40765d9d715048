"""A corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import concluded
from plumbline.llm.exact_dedup import exact_dedup
from plumbline.llm.mixing import mixed_documents
from plumbline.llm.ngram_join import drop_near_copies
from plumbline.llm.packing import pack_documents
from plumbline.llm.queries import VOCABULARY
from plumbline.llm.toxicity import drop_toxic
from plumbline.sources.tables import read_table

WORDS, SIMILAR = 5, 80  # the near-duplicate stage: words per shingle, and least Jaccard similarity in percent


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, size=WORDS, percent=SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, VOCABULARY, end_id=1)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_similar),
    ("source mixing", mix_sources),
    ("packing", pack_windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = concluded("stage", stage, spark, docs, sf_dir)
    return docs
