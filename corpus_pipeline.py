"""Documents to training tokens: quality rules, near duplicates, benchmark leaks, mixing, ORC files.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and its result is
written as Parquet and read again. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, jaccard, mixing, orc_tokens, quality
from ledgerline.llm.frames import documents, remove, scratch, stored, workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose base counts pass and whose words lie in content lines; the rest goes."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.fit(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files, as read back: where each document's ids begin, how many, and their checksum."""
    return orc_tokens.report(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing", source_mix),
    ("token output", token_files),
]

# The field of the first stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage has stored goes when its result is written, and that with the next one's.

    The token files of the last stage stay: they are the product, and the result reads them.
    """
    docs, before = documents(spark, sf_dir), None
    for k, (_, stage) in enumerate(STAGES[:-1]):
        place = scratch(spark, f"stage{k}")
        with workspace(spark):
            docs = stored(stage(spark, docs, sf_dir), f"stage{k}", place)
        if before:
            remove(spark, before)
        before = place
    _, last = STAGES[-1]
    result = last(spark, docs, sf_dir)
    if before:
        remove(spark, before)
    return result
