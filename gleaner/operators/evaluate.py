"""Side-by-side tables and agreement between retrievers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators.fusion import FUSED_DECIMALS, RANK_OFFSET
from gleaner.operators.ranking import top_k_per_group, with_rank


def side_by_side(
    queries: DataFrame, semantic: DataFrame, lexical: DataFrame, title: str = "product_title"
) -> DataFrame:
    """Titles of both rankings next to each other, rank by rank; the shorter list is padded with nulls."""
    left = semantic.select("query_id", "rank", F.col(title).alias("semantic_search_results"))
    right = lexical.select("query_id", "rank", F.col(title).alias("bm25_search_results"))
    both = left.join(right, ["query_id", "rank"], "full_outer")
    return queries.select("query_id", "query").join(both, "query_id").select(
        "query_id", "rank", "query", "semantic_search_results", "bm25_search_results"
    )


def overlap_at_k(a: DataFrame, b: DataFrame, k: int, id_col: str = "chunk_id") -> DataFrame:
    """Per query, the number of items that both top-k lists hold, and its share of k."""
    marked = (
        a.where(F.col("rank") <= k)
        .select("query_id", id_col, F.lit(1).alias("a"), F.lit(0).alias("b"))
        .unionByName(
            b.where(F.col("rank") <= k).select("query_id", id_col, F.lit(0).alias("a"), F.lit(1).alias("b"))
        )
    )
    items = marked.groupBy("query_id", id_col).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    shared = F.sum(F.col("a") * F.col("b"))
    return items.groupBy("query_id").agg(shared.alias("shared"), (shared / k).alias("overlap"))


def recall_at_k(hits: DataFrame, relevant: DataFrame, k: int, id_col: str = "chunk_id") -> DataFrame:
    """Per query with known positives: how many there are, how many the top k holds, and the ratio."""
    found = hits.where(F.col("rank") <= k).select("query_id", id_col, F.lit(1).alias("hit")).distinct()
    known = relevant.select("query_id", id_col).distinct().join(found, ["query_id", id_col], "left")
    total, got = F.count(F.lit(1)), F.count("hit")
    return known.groupBy("query_id").agg(
        total.alias("relevant"), got.alias("found"), (got / total).alias("recall")
    )


def label_precision(hits: DataFrame, k: int) -> DataFrame:
    """Per query, the share of its top k whose ``label`` equals the ``query_label``."""
    same = F.avg((F.col("label") == F.col("query_label")).cast("double"))
    return hits.where(F.col("rank") <= k).groupBy("query_id").agg(same.alias("precision"))


def weight_sweep(
    lexical: DataFrame,
    semantic: DataFrame,
    weights: Sequence[float],
    id_col: str = "chunk_id",
    offset: int = RANK_OFFSET,
) -> DataFrame:
    """Fused rankings for a grid of lexical weights, from one pass over the two lists."""
    grid = F.explode(F.array(*[F.lit(float(w)) for w in weights]))
    share = F.col("bm25_weight")
    lists = lexical.select("query_id", "rank", id_col, F.lit(0).alias("list")).unionByName(
        semantic.select("query_id", "rank", id_col, F.lit(1).alias("list"))
    )
    weight = F.when(F.col("list") == 0, share).otherwise(1 - share)
    fused = (
        lists.withColumn("bm25_weight", grid)
        .groupBy("bm25_weight", "query_id", id_col)
        .agg(
            F.sum(weight / (F.col("rank") + offset)).alias("rrf"),
            F.min(F.struct("list", "rank")).alias("_seen"),
        )
    )
    order = [F.round("rrf", FUSED_DECIMALS).desc(), F.asc("_seen")]
    return with_rank(fused, ["bm25_weight", "query_id"], order).drop("_seen")


def sweep_recall(swept: DataFrame, relevant: DataFrame, k: int, id_col: str = "chunk_id") -> DataFrame:
    """Mean recall of each weight over the queries with known positives."""
    known = relevant.select("query_id", id_col).distinct()
    totals = known.groupBy("query_id").agg(F.count(F.lit(1)).alias("relevant"))
    found = (
        swept.where(F.col("rank") <= k)
        .join(known, ["query_id", id_col])
        .groupBy("bm25_weight", "query_id")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    per_query = (
        swept.select("bm25_weight", "query_id")
        .distinct()
        .join(totals, "query_id")
        .join(found, ["bm25_weight", "query_id"], "left")
        .na.fill(0, ["found"])
    )
    return per_query.groupBy("bm25_weight").agg(F.avg(F.col("found") / F.col("relevant")).alias("recall"))


def chunk_size_sweep(documents: DataFrame, sizes: Sequence[tuple[int, int]], chunker, **options) -> DataFrame:
    """Number and mean length of chunks for a grid of (size, overlap) settings."""
    tables = [
        chunker(documents, size, overlap, **options)
        .agg(F.count(F.lit(1)).alias("chunks"), F.avg(F.char_length("text")).alias("mean_chars"))
        .select(F.lit(size).alias("chunk_size"), F.lit(overlap).alias("chunk_overlap"), "chunks", "mean_chars")
        for size, overlap in sizes
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def rerank(pool: DataFrame, score: Column, k: int | None = None, id_col: str = "chunk_id") -> DataFrame:
    """Second scoring pass over the first-stage pool only, ranks renewed."""
    scored = pool.withColumnRenamed("rank", "first_rank").withColumn("rerank_score", score)
    order = [F.round("rerank_score", 9).desc(), F.asc(id_col)]
    if k is None:
        return with_rank(scored, ["query_id"], order)
    return top_k_per_group(scored, ["query_id"], order, k)


def rubric_scores(judgements: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Share of yes answers per dimension of a yes/no rubric."""
    entries = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("double").alias("yes")) for d in dimensions]
    )
    return (
        judgements.select(F.inline(entries))
        .groupBy("dimension")
        .agg(F.count("yes").alias("judged"), F.avg("yes").alias("share"))
    )
