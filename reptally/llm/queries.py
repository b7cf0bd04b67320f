"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reptally.llm import audit, ctw, decontamination, linededup, packing, pii, ppm, quality, sharding, simhash, trie, vectors, warc
from reptally.llm.common import table

#: In production the key comes from a secret store; it is a parameter of the operator.
PSEUDONYM_KEY = "documents-of-this-corpus"


def op1_balanced_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY).select("doc_id", "text")


def op3_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op4_patience_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents"), report=True)


def op5_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=3, size=3)


def op6_pruned_graph_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bounded_space_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_ngram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op11_partial_matching_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.predict(table(spark, sf_dir, "documents"))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_balanced_label_propagation,
        op2_feistel_pseudonyms,
        op3_context_tree_weighting,
        op4_patience_line_dedup,
        op5_simhash_pigeonhole,
        op6_pruned_graph_near_duplicates,
        op7_hierarchical_quality,
        op8_bounded_space_packing,
        op9_ngram_decontamination,
        op10_warc_capture_index,
        op11_partial_matching_language,
        op12_filter_interaction_audit,
        op13_conversation_prefix_trie,
    )
}
