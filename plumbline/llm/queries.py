"""The operators on the driver's tables, and SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F



from ..sources.tables import read_table
from . import collocations, exact_dedup, mixing, neighbours, ngram_join, oracles, packing, prefix_trie, quality, simhash, substring_dedup, token_files, toxicity, url_filter

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, *tables: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, folder: build(*(read_table(spark, folder, t) for t in tables))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_url_filter", "pages", sql=oracles.URL_FILTER)
def op1(pages):
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


@query("op2_quality", "documents")
def op2(documents):
    return quality.score_quality(documents)


@query("op3_substring_dedup", "documents")
def op3(documents):
    return substring_dedup.remove_repeats(documents)


@query("op4_nearest", "embeddings")
def op4(embeddings):
    return neighbours.nearest(embeddings, F.col("vec_id") % 100 == 0)


@query("op5_token_files", "documents")
def op5(documents):
    return token_files.token_digests(documents, VOCABULARY, end_id=2)


@query("op6_exact_dedup", "documents", sql=oracles.EXACT_DEDUP)
def op6(documents):
    return exact_dedup.exact_groups(documents)


@query("op7_ngram_join", "documents")
def op7(documents):
    return ngram_join.near_copies(documents)


@query("op8_mixing", "documents", sql=oracles.MIXING)
def op8(documents):
    return mixing.mix(documents)


@query("op9_toxicity", "documents", "labels")
def op9(documents, labels):
    return toxicity.score_documents(documents, labels)


@query("op10_packing", "documents")
def op10(documents):
    return packing.pack_documents(documents, VOCABULARY, end_id=1)


@query("op11_prefix_trie", "conversations", sql=oracles.PREFIX_TRIE)
def op11(conversations):
    return prefix_trie.prefix_trie(conversations)


@query("op12_simhash", "documents")
def op12(documents):
    return simhash.simhash_groups(documents)


@query("op13_collocations", "documents", sql=oracles.COLLOCATIONS)
def op13(documents):
    return collocations.collocations(documents)
