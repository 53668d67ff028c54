"""Counts, distinct values and per-column profiles of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, largest first, value order among equals."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: NaN in a float column becomes null."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns]
    )


def table_profile(df: DataFrame) -> DataFrame:
    """Type, row count and non-null count of every column, from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.col(f"`{f.name}`").alias("non_null"),
            )
            for f in df.schema.fields
        ]
    )
    return counted.select(F.col("_rows").alias("row_count"), F.inline(entries))
