"""Re-ranking evidence from word positions: how near a chunk holds the words that a query has next to each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import Tokeniser, tokenise


def build_positions(chunks: DataFrame, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """``(chunk_id, term, positions)``: one row per chunk and distinct term, positions rising from zero.

    Counted inside each row by runs in the sorted (term, position) pairs, so no token is
    shuffled.  Chunks without text or words give no row.
    """
    tokens = F.coalesce(tokeniser(F.col("text")), F.array().cast("array<string>"))
    pair = F.transform(tokens, lambda term, at: F.struct(term.alias("term"), at.alias("at")))
    words = chunks.select("chunk_id", F.sort_array(pair).alias("w")).where(F.size("w") > 0)
    first = F.filter(
        F.sequence(F.lit(0), F.size("w") - 1),
        lambda i: (i == 0) | (F.col("w")[i]["term"] != F.col("w")[i - 1]["term"]),
    )
    cut = words.select("chunk_id", "w", first.alias("s"))
    ends = F.concat(F.slice("s", F.lit(2), F.size("s")), F.array(F.size("w")))
    runs = cut.select("chunk_id", "w", "s", ends.alias("e"), F.col("w.at").alias("at"))
    entries = F.transform(
        "s",
        lambda start, i: F.struct(
            F.col("w")[start]["term"].alias("term"),
            F.slice("at", start + 1, F.col("e")[i] - start).alias("positions"),
        ),
    )
    return runs.select("chunk_id", F.explode(entries).alias("p")).select("chunk_id", "p.*")


def query_pairs(queries: DataFrame, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """``(query_id, a, b, times)``: different words next to each other in a query, in its order."""
    words = queries.select("query_id", tokeniser(F.col("query")).alias("w"))
    follower = F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0)))
    pairs = F.arrays_zip(F.col("w").alias("a"), follower.alias("b"))
    rows = words.where(F.size("w") > 1).select("query_id", F.inline(pairs))
    return rows.where(F.col("a") != F.col("b")).groupBy("query_id", "a", "b").agg(F.count(F.lit(1)).alias("times"))


def least_distance(a: Column, b: Column) -> Column:
    """Smallest distance between positions of two different words, null where one is absent.

    The nearest two are neighbours once all positions are sorted together.
    """
    sides = [
        F.transform(a, lambda at: F.struct(at.alias("at"), F.lit(0).alias("side"))),
        F.transform(b, lambda at: F.struct(at.alias("at"), F.lit(1).alias("side"))),
    ]
    merged = F.sort_array(F.concat(*sides))
    gaps = F.zip_with(
        F.slice(merged, F.lit(1), F.size(merged) - 1),
        F.slice(merged, F.lit(2), F.size(merged) - 1),
        lambda x, y: F.when(x["side"] != y["side"], y["at"] - x["at"]),
    )
    return F.array_min(gaps)


def with_proximity(
    pool: DataFrame, queries: DataFrame, positions: DataFrame, tokeniser: Tokeniser = tokenise
) -> DataFrame:
    """``pool`` with ``proximity`` and ``phrases``, both from 0 to 1.

    For every pair of different words next to each other in the query, weighted by how
    often it occurs there: ``proximity`` is the mean of one over the squared least
    distance of the two words in the chunk (in either order, 0 where one is absent),
    ``phrases`` the share of pairs that the chunk holds side by side in the query's order.
    Queries without such pairs, and pool rows whose chunk has no positions, get 0 for both.
    ``positions`` may cover more than the pool; only terms of the pool's queries in its
    chunks are joined.  ``pool`` has one row per query and chunk.
    """
    pairs = query_pairs(queries, tokeniser)
    totals = pairs.groupBy("query_id").agg(F.sum("times").alias("_pairs"))
    first = positions.select("chunk_id", F.col("term").alias("a"), F.col("positions").alias("at_a"))
    second = positions.select("chunk_id", F.col("term").alias("b"), F.col("positions").alias("at_b"))
    held = (
        pool.select("query_id", "chunk_id")
        .join(pairs, "query_id")
        .join(first, ["chunk_id", "a"])
        .join(second, ["chunk_id", "b"])
    )
    distance = least_distance(F.col("at_a"), F.col("at_b"))
    in_order = F.arrays_overlap(F.transform("at_a", lambda at: at + 1), F.col("at_b"))
    sums = held.groupBy("query_id", "chunk_id").agg(
        F.sum(F.col("times") / (distance * distance)).alias("_near"),
        F.sum(F.col("times") * in_order.cast("int")).alias("_side_by_side"),
    )
    scored = pool.join(sums, ["query_id", "chunk_id"], "left").join(totals, "query_id", "left")
    share = {
        name: F.coalesce(F.col(source) / F.col("_pairs"), F.lit(0.0))
        for name, source in [("proximity", "_near"), ("phrases", "_side_by_side")]
    }
    return scored.withColumns(share).drop("_near", "_side_by_side", "_pairs")


def pool_positions(pool: DataFrame, chunks: DataFrame, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """Positions of the pool's chunks only, for indexes that store none."""
    asked = pool.select("chunk_id").distinct()
    return build_positions(chunks.select("chunk_id", "text").join(asked, "chunk_id", "left_semi"), tokeniser)
