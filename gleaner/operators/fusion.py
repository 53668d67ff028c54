"""Weighted reciprocal-rank fusion of ranked lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators.ranking import with_rank

# Rank offset, and the share of the lexical list in a hybrid.
RANK_OFFSET = 60
LEXICAL_WEIGHT = 0.4
FUSED_DECIMALS = 12


def complementary(weight: float) -> float:
    return 1 - weight


def stack_lists(lists: Sequence[tuple[DataFrame, float]], columns: Sequence[str]) -> DataFrame:
    """One table of all ranked lists, each row tagged with its list's position and weight."""
    tagged = [
        hits.select("query_id", "rank", *columns, F.lit(i).alias("list"), F.lit(float(w)).alias("weight"))
        for i, (hits, w) in enumerate(lists)
    ]
    return reduce(DataFrame.unionByName, tagged)


def weighted_rrf(
    lists: Sequence[tuple[DataFrame, float]],
    id_col: str = "chunk_id",
    carry: Sequence[str] = (),
    offset: int = RANK_OFFSET,
    limit_k: int | None = None,
) -> DataFrame:
    """Fused ranking ``(query_id, rank, id_col, *carry, rrf)``.

    Each list adds ``weight / (rank + offset)`` to the items it holds.  Items equal
    on ``id_col`` merge, the first one seen lending its ``carry`` columns; equal
    scores keep the order of first appearance.  All items stay unless ``limit_k``.
    """
    columns = [id_col, *[c for c in carry if c != id_col]]
    rows = stack_lists(lists, columns)
    seen = F.struct("list", "rank")
    fused = rows.groupBy("query_id", id_col).agg(
        F.sum(F.col("weight") / (F.col("rank") + offset)).alias("rrf"),
        F.min(seen).alias("_seen"),
        *[F.min_by(c, seen).alias(c) for c in columns[1:]],
    )
    ranked = with_rank(fused, ["query_id"], [F.round("rrf", FUSED_DECIMALS).desc(), F.asc("_seen")])
    if limit_k is not None:
        ranked = ranked.where(F.col("rank") <= limit_k)
    return ranked.select("query_id", "rank", *columns, "rrf")


def hybrid(lexical: DataFrame, semantic: DataFrame, lexical_weight: float = LEXICAL_WEIGHT, **options) -> DataFrame:
    """Lexical list first, the semantic one with the complementary weight."""
    pair = [(lexical, lexical_weight), (semantic, complementary(lexical_weight))]
    return weighted_rrf(pair, **options)
