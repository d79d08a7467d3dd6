"""The registered queries: each operator with production parameters on its whole table.

The query ``pipeline`` is ``corpus_pipeline.run``, which the entry module adds.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.llm import chat_format as chat
from faceoff.llm import chunk_dedup, conversation_trie, decontaminate, lexical_search, license_scan, quality_classifier, quality_rules
from faceoff.llm import sentencepiece_codec as pieces
from faceoff.llm import simhash, token_counts, token_shards, toxicity
from faceoff.llm.common import held_out, table
from faceoff.llm.oracle_sql import ORACLE_SQL
from faceoff.session import scratch_dir

__all__ = ["ORACLE_SQL", "QUERIES"]

TOKEN_LIMIT = 1024
QUALITY_FROM = 0.3
TOXIC_FROM = 0.5
SHARD_KEY = 20240501


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), path)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
        "longest_words", "longest_at",
    )


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-shards")
    n = token_shards.write_shards(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, SHARD_KEY,
    )
    columns = ["slot", "shard", "position", F.col("id").alias("doc_id"), "sequence", "n_tokens", F.sha2("ids", 256).alias("ids_sha256")]
    if not n:
        return spark.createDataFrame([], "slot long, shard long, position long, id long, sequence int, n_tokens int, ids binary").select(*columns)
    return token_shards.read_shards(spark, path).select(*columns)


def _labelled_score(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return _labelled_score(quality_classifier.score(docs, model), QUALITY_FROM)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.language_model(docs))
    return _labelled_score(toxicity.score(docs, scorer), TOXIC_FROM)


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.dedup(table(spark, sf_dir, "documents"), report=True)
    return found.select(
        "doc_id", (F.col("removed_bytes") > 0).alias("has_copies"), "removed_bytes", "removed_words",
        F.col("first_keys").alias("first_doc_ids"), F.sha2("text", 256).alias("text_sha256"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, trees)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations")).drop("prefix")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, found = F.col("base"), F.col("detections")
    return license_scan.scan(table(spark, sf_dir, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(base["start"]).cast("long").alias("first_word"), F.array_max(base["start"]).cast("long").alias("last_word"),
        license_scan.labels_of(base).alias("base_labels"), license_scan.labels_of(base, found).alias("labels"),
        license_scan.score(base, found).alias("score"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_chat_format, op2_simhash, op3_token_counts, op4_decontaminate, op5_token_shards, op6_quality_classifier,
              op7_sentencepiece, op8_toxicity, op9_chunk_dedup, op10_quality_rules,
              op11_conversation_trie, op12_lexical_search, op13_license_scan)
}
