"""Rebuild only the documents whose products received new data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from gleaner.operators.products import META_COLUMNS, combine_reviews, documents_from_sources
from gleaner.sources.writers import write_parquet

# Folders, by a hash of the key, that the reviews of a drop lie in.
KEY_BUCKETS = 256


def rebuild_changed(
    changed: DataFrame,
    meta: DataFrame,
    reviews: DataFrame,
    key: str = "parent_asin",
    k: int = 10,
    columns: Sequence[str] = tuple(META_COLUMNS),
    order: Sequence[str] = (),
    ties: Sequence[str] = (),
    repeated: bool = False,
) -> DataFrame:
    """Documents of the products named in ``changed``, from their whole data."""
    touched = changed.where(F.col(key).isNotNull()).select(key).distinct()
    kept_meta = meta.join(touched, key, "left_semi")
    kept_reviews = combine_reviews(reviews.join(touched, key, "left_semi"), key, k, ties=ties)
    return documents_from_sources(kept_meta, kept_reviews, columns, key, order, repeated)


def refresh(current: DataFrame, changed: DataFrame, rebuilt: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Untouched documents as they are, touched ones as rebuilt."""
    touched = changed.where(F.col(key).isNotNull()).select(key).distinct()
    return current.join(touched, key, "left_anti").unionByName(rebuilt.select(*current.columns))


def latest_documents(spark: SparkSession, root: str, key: str = "parent_asin") -> DataFrame:
    """The newest version of each document in a table written drop by drop; all its rows where the key repeats in a drop."""
    versions = spark.read.parquet(f"{root}/documents")
    newest = F.rank().over(Window.partitionBy(key).orderBy(F.desc("drop")))
    return versions.withColumn("_version", newest).where("_version = 1").drop("_version", "drop")


def follow_reviews(
    spark: SparkSession,
    drops: str,
    schema: StructType,
    meta: DataFrame,
    root: str,
    key: str = "parent_asin",
    k: int = 10,
    columns: Sequence[str] = tuple(META_COLUMNS),
    order: Sequence[str] = (),
    ties: Sequence[str] = (),
) -> StreamingQuery:
    """Process the review files that arrived in ``drops`` since the last run, then stop.

    Each drop is kept under its number, in folders by a hash of the key, and the
    documents of its products are written beside the earlier versions.  Only the folders
    that the drop's keys fall in are read again.  A repeated drop overwrites its own
    folders, so a restart after a failure changes nothing; a drop without rows is passed over.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        session, folder = batch.sparkSession, f"{root}/reviews/drop={number}"
        bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")
        placed = batch.withColumn("bucket", bucket).repartition("bucket")
        placed.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(folder)
        arrived = session.read.parquet(folder)
        touched = [row["bucket"] for row in arrived.select("bucket").distinct().collect()]
        earlier = (F.col("drop") <= number) & F.col("bucket").isin(touched)
        stored = session.read.parquet(f"{root}/reviews").where(earlier).drop("drop", "bucket")
        rebuilt = rebuild_changed(arrived, meta, stored, key, k, columns, order, ties)
        write_parquet(rebuilt, f"{root}/documents/drop={number}")

    stream = spark.readStream.schema(schema).json(drops)
    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
    )


