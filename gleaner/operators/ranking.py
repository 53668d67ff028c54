"""Ranks, top-k per group and first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based rank inside each group; give ``order`` a unique tail so ties are fixed."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window))


def top_k_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group with their rank.

    Spark keeps only k rows per group and map task before the shuffle (up to its
    ``windowGroupLimitThreshold``), so a hot group arrives small.
    """
    return with_rank(df, keys, order, name).where(F.col(name) <= k)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Row-limited subset: the first ``n`` rows, in ``order`` when one is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def element(values: Column, position: int) -> Column:
    """Zero-based element of an array, null past its end."""
    return F.get(values, F.lit(position))


def order_by_rating(hits: DataFrame, rating: str = "average_rating", id_col: str = "chunk_id") -> DataFrame:
    """Hits of each query from best to worst rating; unrated ones last."""
    return with_rank(hits.drop("rank"), ["query_id"], [F.desc_nulls_last(rating), F.asc(id_col)])
