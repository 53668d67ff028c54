"""Blank queries, missing fields, empty results and hit counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.display import MISSING_TITLE, with_default
from gleaner.functions.text import is_blank, strip_ws

# Messages shown instead of an empty list or answer.
NO_HITS = "No results found."
NO_ANSWER = "No answer generated."


def drop_null_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def drop_blank_queries(queries: DataFrame, column: str = "query") -> DataFrame:
    """Trimmed queries without the blank ones."""
    return queries.where(~is_blank(F.col(column))).withColumn(column, strip_ws(F.col(column)))


def with_title_default(hits: DataFrame, column: str = "product_title") -> DataFrame:
    return hits.withColumn(column, with_default(F.col(column), MISSING_TITLE))


def with_message(
    queries: DataFrame, rows: DataFrame, column: str, message: str, key: str = "query_id"
) -> DataFrame:
    """Every query keeps a row; ``message`` stands in where ``column`` is missing or blank."""
    filled = F.when(is_blank(F.col(column)), F.lit(message)).otherwise(F.col(column))
    return queries.join(rows, key, "left").withColumn(column, filled)


def hits_per_query(hits: DataFrame, mode: str | None = None) -> DataFrame:
    """Number of hits per query and mode, with a heading line."""
    tagged = hits if mode is None else hits.withColumn("mode", F.lit(mode))
    counted = tagged.groupBy("query_id", "mode").agg(F.count(F.lit(1)).alias("hits"))
    return counted.withColumn("label", F.format_string("Top %d results — %s mode", "hits", "mode"))
