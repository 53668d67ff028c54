"""Measured size checks that decide between a broadcast and a shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
        return self.rows <= max_rows and self.bytes <= max_bytes


def measure(df: DataFrame, payload: Column) -> Size:
    """Row count and total payload bytes, from one aggregate over the whole table."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(payload).alias("bytes")).first()
    return Size(row["rows"], int(row["bytes"] or 0))


def text_size(df: DataFrame, column: str) -> Size:
    return measure(df, F.octet_length(column) + 16)


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Hint a broadcast only for a side whose size has been checked."""
    return F.broadcast(df) if small else df


FAN_OUT = 8


def spread_scan(scan: DataFrame) -> DataFrame:
    """Redistribute a plain scan that has fewer splits than cores.

    One gzip file or one big row group is one task, however much work follows.  A
    table of many splits passes unchanged.  For scans only: counting the partitions
    of a plan with shuffles would run them.
    """
    splits = scan.rdd.getNumPartitions()
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if splits >= cores else scan.repartition(min(cores, FAN_OUT * max(splits, 1)))
