"""From raw documents to a training mixture, stage by stage; each stage's result is stored before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, jaccard, language, mixing, sentences
from gleaner.llm.common import saved
from gleaner.llm.queries import SOURCE_WEIGHTS, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language compression cannot tell."""
    content = language.dictionaries(docs)
    return language.identify(docs, content).where(~F.col("lang_rejected")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of every group of similar word 5-grams (0.8)."""
    return jaccard.keep_first(docs, jaccard.Similarity(n=5, share=4, parts=5))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take sentences out that repeat passages of earlier documents; n_chars follows the text."""
    cleaned = sentences.remove_repeats(docs)
    return cleaned.withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    ).select(docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Choose copies of documents so that sources meet their target weights; documents without a copy go."""
    sized = docs.withColumn("size", mixing.word_count("text"))
    return mixing.mix(sized, SOURCE_WEIGHTS, share=1.5, most=2.0).where("copies > 0")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_languages),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

# The stages learn dictionaries, compare sets by similarity and sample at random: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
