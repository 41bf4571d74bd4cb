"""The queries of the training-data operators, one ``opN_<name>`` for each.

Each query applies its operator, with production parameters, to the whole of
its table and derives the columns it returns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, work_dir
from . import (bwt_dedup, embedding_join, feast_whitening, language_id, mixing, ngram_join, packing,
               positional_index, prefix_trie, quote_links, risk_thresholds, simple8b, url_filter)
from .oracle import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and boosted trees over every url of `pages`."""
    return url_filter.judge(read_table(spark, sf_dir, "pages"))[0]


@register
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-first backoff language of every document of `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    held_out = language_id.held_out()
    model = language_id.fit(docs.filter(~held_out))
    return (language_id.predict(docs, model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@register
def op5_simple8b_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple-8b block files of `documents`, read back."""
    path = work_dir(spark, "simple8b")
    simple8b.write_blocks(read_table(spark, sf_dir, "documents"), path,
                          public_tokenizers.path("byte_bpe_50k.json"))
    return simple8b.read_documents(spark, path)


@register
def op6_risk_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk-controlled quality rules over `documents`, held against `labels`."""
    got = risk_thresholds.judge(read_table(spark, sf_dir, "documents"),
                                read_table(spark, sf_dir, "labels"))
    return got.select("doc_id", *risk_thresholds.BASE, "base_failed", "kept")


@register
def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum-of-squares packing of `documents` into sequences of 2048 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


@register
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-cost-flow mix of `documents`, one source a document."""
    got = mixing.mix(read_table(spark, sf_dir, "documents"), F.array("source"),
                     mixing.word_count(F.col("text")))
    return got.select("doc_id", "size", "source_size", "target", "taken")


@register
def op2_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply threads of `conversations`, shown with nested quotations."""
    return quote_links.link_quotes(
        quote_links.quoting_messages(read_table(spark, sf_dir, "conversations")))


@register
def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all `embeddings` with cosine >= 0.9."""
    return embedding_join.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@register
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all `documents` whose 5-word shingle sets are 0.8 similar."""
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


@register
def op9_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of `documents` that repeat 50-byte strings of smaller doc_ids."""
    return bwt_dedup.deduplicate(read_table(spark, sf_dir, "documents")).drop("kept_text")


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix nodes of all `conversations`, rebuilt with the openings of their blocks."""
    return prefix_trie.openings_trie(read_table(spark, sf_dir, "conversations"))


@register
def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all `documents` inside of ten-word phrases of `benchmark`."""
    got = positional_index.decontaminate(read_table(spark, sf_dir, "documents"),
                                         read_table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


@register
def op13_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `embeddings` on the 16 leading components of their distinct vectors."""
    return feast_whitening.whitened_embeddings(read_table(spark, sf_dir, "embeddings"))
