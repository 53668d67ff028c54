"""Parquet and CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleaner.session import work_dir


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back."""
    path = work_dir(df.sparkSession)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str = "index") -> DataFrame:
    """Consecutive numbers from zero over a total order.

    A range sort stored once with the place of each row in its partition, then the
    rows of the partitions before are added; a global ``row_number`` would move the
    whole table into one task.  Only the table of partition sizes is numbered in one.
    """
    part = F.shiftright("_place", 33)  # the id's upper bits are the partition's number
    rows = saved(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())).withColumn("_part", part)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    numbered = rows.join(sizes.select("_part", before.alias("_before")), "_part")
    within = F.col("_place") - F.shiftleft("_part", 33)
    return numbered.select((F.col("_before") + within).alias(name), *df.columns)


def write_csv(
    df: DataFrame, path: str, index_order: Sequence[str | Column] | None = None, mode: str = "overwrite"
) -> None:
    """CSV with a header; quotes and line breaks inside values survive.

    With ``index_order`` a first column ``index`` numbers the rows in that order.
    """
    out = df if index_order is None else with_row_index(df, index_order)
    out.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back what :func:`write_csv` wrote."""
    return (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path)
    )
