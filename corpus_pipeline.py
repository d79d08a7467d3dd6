"""A training corpus from raw documents, in five stages.

``run`` applies the stages to ``documents``; each one's rows are written to the
shared scratch folder as Parquet and read back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faceoff.llm import chunk_dedup, decontaminate, quality_rules, sentencepiece_codec, simhash
from faceoff.llm.common import ship_code, table, written

PIECES = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.keep(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    ship_code(spark)
    return simhash.keep_one(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut out; n_chars follows the text."""
    ship_code(spark)
    found = chunk_dedup.dedup(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else found


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, same_text) of what is left; same_text: the ids decode to the text."""
    ship_code(spark)
    return sentencepiece_codec.coded_both_ways(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", substrings),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", token_ids),
]

# SQL can express neither the trees of the first stage nor the content-defined chunks of the third.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k}")
    return docs
