"""The registered queries of the corpus operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    chat,
    context_tree,
    decontaminate,
    jaccard,
    merkle,
    mixing,
    orc_tokens,
    quality,
    repeats,
    secrets,
    token_count,
    toxicity,
    whitening,
)
from ledgerline.llm.frames import documents
from ledgerline.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op10_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.report(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op1_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(documents(spark, sf_dir))


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.scores(documents(spark, sf_dir))


def op3_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op4_lexicon_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scores(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op5_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orc_tokens.report(documents(spark, sf_dir))


def op8_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.counts(documents(spark, sf_dir))


def op9_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir))


def op6_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir))


def op7_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.report(documents(spark, sf_dir), items, near=decontaminate.NEAR)
    return found.drop("key_a", "key_b")


def op11_anchored_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(documents(spark, sf_dir))


def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents(spark, sf_dir)
    return whitening.report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_sibling_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(documents(spark, sf_dir))


QUERIES = {
    "op1_jaccard_regions": op1_jaccard_regions,
    "op2_context_tree": op2_context_tree,
    "op3_perspective_rotation": op3_perspective_rotation,
    "op4_lexicon_automata": op4_lexicon_automata,
    "op5_orc_token_ids": op5_orc_token_ids,
    "op6_secret_ownership": op6_secret_ownership,
    "op7_positional_index": op7_positional_index,
    "op8_viterbi_counts": op8_viterbi_counts,
    "op9_pivotal_mix": op9_pivotal_mix,
    "op10_line_labels": op10_line_labels,
    "op11_anchored_repeats": op11_anchored_repeats,
    "op12_qd_whitening": op12_qd_whitening,
    "op13_sibling_manifest": op13_sibling_manifest,
}
