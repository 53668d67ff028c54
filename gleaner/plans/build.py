"""From raw sources to documents, chunks and stored indexes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from gleaner.operators.chunking import (
    LEXICAL_OVERLAP,
    LEXICAL_SIZE,
    SEMANTIC_OVERLAP,
    SEMANTIC_SIZE,
    chunk_recursive,
)
from gleaner.operators.dense import Embedder, embed
from gleaner.operators.lexical import build_index
from gleaner.operators.products import META_COLUMNS, combine_reviews, documents_from_sources
from gleaner.plans.search import Corpus
from gleaner.sources.index_store import build_if_absent, lexical_index, vector_index
from gleaner.sources.readers import read_meta, read_reviews
from gleaner.sources.writers import write_parquet


def product_documents(
    spark: SparkSession,
    meta_path: str,
    reviews_path: str,
    top_k_reviews: int = 10,
    columns: Sequence[str] = tuple(META_COLUMNS),
    key: str = "parent_asin",
    spread: int | None = None,
) -> DataFrame:
    """One document per product straight from the raw files: one shuffle per source.

    ``spread`` deals the lines of few large gzip files to that many tasks.
    """
    meta = read_meta(spark, meta_path, [key, *[c for c in columns if c != key]], spread=spread)
    reviews = combine_reviews(read_reviews(spark, reviews_path, spread=spread), key, top_k_reviews)
    return documents_from_sources(meta, reviews, columns, key)


def build_corpus(
    spark: SparkSession,
    documents: DataFrame,
    root: str,
    make_embedder: Callable[[], Embedder],
    key: str = "parent_asin",
    shared_chunks: bool = True,
    rewrite: bool = False,
) -> Corpus:
    """Store (or reuse) both indexes of a document table under ``root``.

    With ``shared_chunks`` both indexes hold the same chunks and fuse by chunk id.
    Otherwise the lexical one uses its own, longer chunks; fuse those by text.
    """

    def stored_chunks(name: str, size: int, overlap: int) -> DataFrame:
        def build(folder: str) -> None:
            write_parquet(chunk_recursive(documents, size, overlap, key), f"{folder}/chunks")

        folder = build_if_absent(spark, f"{root}/{name}", build, rewrite)
        return spark.read.parquet(f"{folder}/chunks")

    # Chunks are cut and stored once; what is indexed comes from the stored ones.
    short = stored_chunks("chunks", SEMANTIC_SIZE, SEMANTIC_OVERLAP)
    long = short if shared_chunks else stored_chunks("long_chunks", LEXICAL_SIZE, LEXICAL_OVERLAP)
    lexical = lexical_index(spark, f"{root}/lexical", lambda: build_index(long), rewrite)
    vectors = vector_index(spark, f"{root}/vectors", lambda: embed(short, "text", make_embedder), rewrite)
    return Corpus(lexical, vectors, None if shared_chunks else short, make_embedder)
