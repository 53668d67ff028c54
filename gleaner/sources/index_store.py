"""Lexical and vector indexes stored as Parquet tables.

A build writes into a folder of its own and is listed in the ``builds`` table last,
so a job that dies half-way leaves the earlier build in use.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.lexical import LexicalIndex, term_bucket
from gleaner.sources.writers import write_parquet

TERM_BUCKETS = 64


def latest_build(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete build, or None."""
    try:
        builds = spark.read.parquet(f"{root}/builds")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = builds.agg(F.max_by("folder", "built_at").alias("folder")).first()
    return row["folder"]


def _new_folder(root: str) -> str:
    return f"{root.rstrip('/')}/build-{uuid.uuid4().hex}"


def _publish(spark: SparkSession, root: str, folder: str) -> None:
    row = spark.range(1).select(F.lit(folder).alias("folder"), F.current_timestamp().alias("built_at"))
    row.coalesce(1).write.mode("append").parquet(f"{root}/builds")


def build_if_absent(
    spark: SparkSession, root: str, build: Callable[[str], None], rewrite: bool = False
) -> str:
    """Run ``build(folder)`` unless a complete build exists; return the folder to read."""
    folder = latest_build(spark, root)
    if folder is None or rewrite:
        folder = _new_folder(root)
        build(folder)
        _publish(spark, root, folder)
    return folder


def save_lexical(index: LexicalIndex, folder: str, buckets: int = TERM_BUCKETS) -> None:
    """Write the four tables, postings and terms in folders by term bucket.

    A search reads only the buckets of its terms.  The rebalance lets adaptive
    execution split an oversized bucket over several tasks, so a term found in every
    chunk does not end up in one of them.
    """
    postings = index.postings.withColumn("bucket", term_bucket(buckets))
    (
        postings.hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "term", "chunk_id")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("bucket")
        .parquet(f"{folder}/postings")
    )
    spark = index.postings.sparkSession
    stored = spark.read.parquet(f"{folder}/postings")
    # Statistics come from the stored postings: the text is tokenised once.
    terms = stored.groupBy("bucket", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("ctf")
    )
    (
        terms.hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "term")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("bucket")
        .parquet(f"{folder}/terms")
    )
    write_parquet(index.chunks, f"{folder}/chunks")
    reread = LexicalIndex.from_terms(
        stored.drop("bucket"),
        spark.read.parquet(f"{folder}/terms").drop("bucket"),
        spark.read.parquet(f"{folder}/chunks"),
    )
    write_parquet(reread.corpus.withColumn("buckets", F.lit(buckets)), f"{folder}/corpus")


def load_lexical(spark: SparkSession, folder: str) -> LexicalIndex:
    return LexicalIndex(
        postings=spark.read.parquet(f"{folder}/postings"),
        terms=spark.read.parquet(f"{folder}/terms"),
        corpus=spark.read.parquet(f"{folder}/corpus"),
        chunks=spark.read.parquet(f"{folder}/chunks"),
    )


def lexical_index(
    spark: SparkSession,
    root: str,
    make_index: Callable[[], LexicalIndex],
    rewrite: bool = False,
    buckets: int = TERM_BUCKETS,
) -> LexicalIndex:
    """The stored index under ``root``, built first when it is missing."""
    folder = build_if_absent(
        spark, root, lambda path: save_lexical(make_index(), path, buckets), rewrite
    )
    return load_lexical(spark, folder)


def vector_index(
    spark: SparkSession, root: str, make_vectors: Callable[[], DataFrame], rewrite: bool = False
) -> DataFrame:
    """The stored ``(chunk_id, embedding, ...)`` table under ``root``, built first when missing."""
    folder = build_if_absent(
        spark, root, lambda path: write_parquet(make_vectors(), f"{path}/vectors"), rewrite
    )
    return spark.read.parquet(f"{folder}/vectors")
