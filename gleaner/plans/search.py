"""Search a corpus by mode, and build grounded prompts for a query set."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import Tokeniser, tokenise
from gleaner.operators import answers, evaluate, fusion
from gleaner.operators.dense import Embedder, HashingEmbedder, embed, hashing_embedder, knn
from gleaner.operators.lexical import TOP_K, LexicalIndex, bm25_search
from gleaner.plans.sizing import MAX_ROWS
from gleaner.sources.writers import saved

# Search modes and their labels.
MODES = {"bm25": "BM25", "semantic": "Semantic", "hybrid": "Hybrid"}


@dataclass(frozen=True)
class Corpus:
    """A lexical index, chunk vectors ``(chunk_id, embedding)``, and how queries are read.

    ``vector_chunks`` are the chunks of the vectors where they are cut in another way than
    the lexical ones.
    """

    lexical: LexicalIndex
    vectors: DataFrame
    vector_chunks: DataFrame | None = None
    make_embedder: HashingEmbedder | Callable[[], Embedder] = hashing_embedder()
    tokeniser: Tokeniser = tokenise
    lexical_weight: float = fusion.LEXICAL_WEIGHT

    @property
    def chunks(self) -> DataFrame:
        return self.lexical.chunks


def lexical_hits(queries: DataFrame, corpus: Corpus, k: int = TOP_K, pad_to_k: bool = False) -> DataFrame:
    return bm25_search(queries, corpus.lexical, k, corpus.tokeniser, pad_to_k)


def semantic_hits(queries: DataFrame, corpus: Corpus, k: int = TOP_K, metric: str = "l2") -> DataFrame:
    asked = embed(queries.select("query_id", "query"), "query", corpus.make_embedder)
    return knn(asked, corpus.vectors, k, metric)


def hybrid_hits(
    queries: DataFrame, corpus: Corpus, k: int = TOP_K, by_text: bool = False, limit_k: int | None = None
) -> DataFrame:
    """Fused hits: up to 2k rows per query unless ``limit_k``.

    ``by_text`` merges chunks with equal text, as a search over two separately
    chunked indexes needs; otherwise chunks merge by id.  A text that several queries
    ask is searched once.
    """
    asked, names = distinct_queries(queries)
    fused = _fused(asked, corpus, k, by_text, limit_k)
    same = F.col("twin").eqNullSafe(F.col("query_id"))
    return fused.join(names, same).select("asker", *fused.columns[1:]).withColumnRenamed("asker", "query_id")


def distinct_queries(queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One ``(query_id, query)`` for all queries with the same texts, and the ``(asker, twin)`` that it stands for."""
    texts = queries.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("query"))).alias("texts"))
    first = F.min("query_id").over(Window.partitionBy("texts"))
    names = saved(texts.withColumn("twin", first))
    asked = names.where(F.col("query_id").eqNullSafe(F.col("twin"))).select("query_id", F.inline("texts"))
    return asked, names.select(F.col("query_id").alias("asker"), "twin")


def _fused(queries: DataFrame, corpus: Corpus, k: int, by_text: bool, limit_k: int | None) -> DataFrame:
    lists = [lexical_hits(queries, corpus, k), semantic_hits(queries, corpus, k)]
    if not by_text:
        return fusion.hybrid(*lists, lexical_weight=corpus.lexical_weight, limit_k=limit_k)
    tables = [corpus.chunks, corpus.chunks if corpus.vector_chunks is None else corpus.vector_chunks]
    keyed = [
        with_chunk_columns(hits, chunks, ["text"], queries, k).withColumn("content_key", F.md5("text"))
        for hits, chunks in zip(lists, tables)
    ]
    return fusion.hybrid(
        *[hits.select("query_id", "rank", "chunk_id", "content_key") for hits in keyed],
        lexical_weight=corpus.lexical_weight,
        id_col="content_key",
        carry=["chunk_id"],
        limit_k=limit_k,
    )


def search(queries: DataFrame, corpus: Corpus, mode: str, k: int = TOP_K) -> DataFrame:
    """Hits ``(query_id, rank, chunk_id, mode)`` of the chosen retriever, without scores."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    find = {"bm25": lexical_hits, "semantic": semantic_hits, "hybrid": hybrid_hits}[mode]
    return find(queries, corpus, k).select("query_id", "rank", "chunk_id", F.lit(MODES[mode]).alias("mode"))


def with_chunk_columns(
    hits: DataFrame, chunks: DataFrame, columns: Sequence[str], queries: DataFrame, k: int
) -> DataFrame:
    """Look up chunk columns for hits of ``queries``, at most 2k each.

    The hits are stored first, so that the retrieval behind them runs once for their ids
    and for the join.  The number of queries bounds them: a checked query set lets their
    ids be broadcast and the chunk table is scanned without a shuffle.  A hit whose chunk
    is missing stays, with nulls.
    """
    hits = saved(hits)
    few = queries.limit(MAX_ROWS // (2 * k) + 1).count() <= MAX_ROWS // (2 * k)
    ids = hits.select("chunk_id").distinct()
    found = chunks.select("chunk_id", *columns).join(F.broadcast(ids) if few else ids, "chunk_id", "left_semi")
    return hits.join(found, "chunk_id", "left")


def side_by_side(queries: DataFrame, corpus: Corpus, title: str = "product_title", k: int = TOP_K) -> DataFrame:
    """Titles of both retrievers rank by rank; the chunk table is read once for both lists."""
    lists = [semantic_hits(queries, corpus, k).drop("distance"), lexical_hits(queries, corpus, k).drop("score")]
    both = lists[0].withColumn("list", F.lit(0)).unionByName(lists[1].withColumn("list", F.lit(1)))
    titled = saved(with_chunk_columns(both, corpus.chunks, [title], queries, k))
    return evaluate.side_by_side(queries, titled.where("list = 0"), titled.where("list = 1"), title)


def grounded_prompts(
    queries: DataFrame,
    corpus: Corpus,
    system_text: str = answers.SYSTEM_TEXT,
    k: int = TOP_K,
    mode: str = "hybrid",
    key: str = "parent_asin",
    title: str = "product_title",
    rating: str = "average_rating",
) -> DataFrame:
    """``(query_id, query, context, prompt)``: retrieve once, then one prompt per query."""
    hits = search(queries, corpus, mode, k)
    full = with_chunk_columns(hits, corpus.chunks, [key, title, rating, "text"], queries, k)
    contexts = answers.context_by_query(full, key, title, rating)
    ready = answers.with_context(queries.select("query_id", "query"), contexts)
    prompt = answers.chat_prompt(F.lit(system_text), F.col("context"), F.col("query"))
    return ready.withColumn("prompt", prompt)
