import json

from pyspark.sql import functions as F

from gleaner.operators.products import combine_reviews, documents_from_sources
from gleaner.sources.readers import REVIEW_COLUMNS, REVIEWS, narrow
from gleaner.streaming.refresh import follow_reviews, latest_documents, rebuild_changed, refresh

COLUMNS = ["title", "average_rating"]


def drop(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def test_documents_follow_the_drops(spark, tmp_path, rows):
    meta = spark.createDataFrame(
        [("p", "P", 1.0), ("q", "Q", 2.0)], "parent_asin string, title string, average_rating double"
    )
    drops, root = tmp_path / "drops", str(tmp_path / "store")

    def run():
        schema = narrow(REVIEWS, REVIEW_COLUMNS)
        follow_reviews(spark, str(drops), schema, meta, root, columns=COLUMNS).awaitTermination()
        return rows(latest_documents(spark, root), "parent_asin", "document")

    drop(drops, "1.json", [{"parent_asin": "p", "title": "good", "helpful_vote": 1},
                           {"parent_asin": "q", "title": "fine", "helpful_vote": 2}])
    assert run() == [("p", "P good"), ("q", "Q fine")]
    drop(drops, "2.json", [{"parent_asin": "p", "title": "best", "helpful_vote": 5}])
    assert run() == [("p", "P best | good"), ("q", "Q fine")]
    # Only the touched product was written again, and a run without news adds nothing.
    second = spark.read.parquet(f"{root}/documents").where("drop = 1")
    assert rows(second, "parent_asin") == [("p",)]
    assert run() == [("p", "P best | good"), ("q", "Q fine")]
    assert spark.read.parquet(f"{root}/documents").select("drop").distinct().count() == 2


def test_batch_refresh_equals_a_full_rebuild(spark, rows):
    meta = spark.range(40).select(
        F.col("id").cast("string").alias("parent_asin"), F.concat(F.lit("T"), "id").alias("title"),
        F.col("id").cast("double").alias("average_rating"),
    )
    reviews = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 40).cast("string")).alias("parent_asin"),
        F.concat(F.lit("r"), "id").alias("title"), (F.col("id") % 11).alias("helpful_vote"),
    )
    old, new = reviews.where("title < 'r3'"), reviews.where("title >= 'r3'")
    current = documents_from_sources(meta, combine_reviews(old), COLUMNS)
    rebuilt = rebuild_changed(new, meta, reviews, columns=COLUMNS)
    full = documents_from_sources(meta, combine_reviews(reviews), COLUMNS)
    assert rows(refresh(current, new, rebuilt)) == rows(full)
