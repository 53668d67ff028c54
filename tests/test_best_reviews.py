import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleaner.operators.products import combine_reviews, documents_from_sources
from gleaner.streaming.best_reviews import first_per_key, follow_best_reviews, latest_best
from gleaner.streaming.refresh import latest_documents

SCHEMA = "parent_asin string, title string, helpful_vote double, line long"
COLUMNS = ["title", "average_rating"]


@pytest.fixture
def follow(spark, tmp_path):
    drops, root = str(tmp_path / "drops"), str(tmp_path / "store")
    meta = spark.createDataFrame(
        [("p", "P", 1.0), ("q", "Q", 2.0), ("r", "R", None), ("unseen", "U", 3.0)],
        "parent_asin string, title string, average_rating double",
    )

    def run(rows=None, **options):
        if rows is not None:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(drops)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(drops)
        kept = {"k": 3, "columns": COLUMNS, "ties": ["line"]} | options
        follow_best_reviews(spark, stream, meta, root, **kept).awaitTermination()

    run.drops, run.root, run.meta = drops, root, meta
    return run


def test_best_reviews_follow_drops_in_any_order(spark, follow, rows):
    follow([("p", "late", 1.0, 9), ("q", "only", None, 1), (None, "nobody", 9.0, 1)])
    assert rows(latest_best(spark, follow.root)) == [("p", "late"), ("q", "only")]
    follow([("p", "early", 1.0, 2), ("p", "best", 7.0, 3), ("p", None, 5.0, 4), ("r", None, 1.0, 1)])
    # The null title takes the second of three places and pushes the late one out.
    assert rows(latest_best(spark, follow.root)) == [("p", "best | early"), ("q", "only"), ("r", None)]
    follow([("p", "odd", math.nan, 5)])
    assert rows(latest_best(spark, follow.root), "parent_asin", "combined_reviews")[0] == ("p", "odd | best")
    everything = spark.read.parquet(follow.drops)
    batch = combine_reviews(everything, k=3, ties=["line"])
    assert rows(latest_best(spark, follow.root)) == rows(batch)
    touched = follow.meta.where("parent_asin <> 'unseen'")
    assert rows(latest_documents(spark, follow.root)) == rows(documents_from_sources(touched, batch, COLUMNS))


def test_unchanged_products_are_not_written_again(spark, follow, rows):
    follow([("p", "a", 5.0, 1), ("p", "b", 4.0, 2), ("p", "c", 3.0, 3), ("q", "d", 1.0, 4)])
    follow([("p", "weak", 2.0, 5), ("q", "e", 2.0, 6)])
    second = spark.read.parquet(f"{follow.root}/best").where("drop = 1")
    assert rows(second, "parent_asin", "combined_reviews") == [("q", "e | d")]
    follow()  # a run without news
    assert rows(latest_best(spark, follow.root)) == [("p", "a | b | c"), ("q", "e | d")]


def test_a_drop_that_failed_is_repeated_without_counting_twice(spark, follow, rows, monkeypatch):
    from gleaner.streaming import best_reviews

    follow([("p", "a", 5.0, 1)])
    write = best_reviews.write_parquet

    def fail(df, path):
        if "/documents/" in path:
            raise OSError("lost")
        write(df, path)

    monkeypatch.setattr(best_reviews, "write_parquet", fail)
    with pytest.raises(Exception, match="lost"):
        follow([("p", "b", 6.0, 2), ("p", "b", 6.0, 2)])
    monkeypatch.setattr(best_reviews, "write_parquet", write)
    follow()
    assert rows(latest_best(spark, follow.root)) == [("p", "b | b | a")]
    assert rows(latest_documents(spark, follow.root), "document") == [("P b | b | a",)]


def test_the_cut_of_a_batch_keeps_the_first_rows_of_each_key(spark, rows):
    table = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("parent_asin"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 11 == 0, float("nan"))
        .otherwise((F.col("id") % 5).cast("double")).alias("helpful_vote"),
        F.when(F.col("id") % 13 != 0, F.col("id") * 7919 % 2003).alias("line"),
        F.col("id").alias("title"),
    )
    batch = table.toArrow().combine_chunks().to_batches()[0]
    cut = first_per_key(batch, "parent_asin", "helpful_vote", ["line", "title"], 4)
    got = spark.createDataFrame(pa.Table.from_batches([cut]))
    assert cut.num_rows == 4 * table.select("parent_asin").distinct().count()
    args = {"k": 4, "ties": ["line", "title"]}
    as_text = F.col("title").cast("string")
    whole = combine_reviews(table.withColumn("shown", as_text), text="shown", **args)
    assert rows(combine_reviews(got.withColumn("shown", as_text), text="shown", **args)) == rows(whole)


def test_rows_of_a_repeated_product_all_follow(spark, follow, rows):
    follow.meta.createOrReplaceTempView("meta_once")
    twice = spark.table("meta_once").unionByName(spark.table("meta_once").where("parent_asin = 'p'").withColumn("title", F.lit("P2")))
    for batch in [[("p", "a", 1.0, 1)], [("p", "b", 2.0, 2)]]:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(follow.drops)
        stream = spark.readStream.schema(SCHEMA).parquet(follow.drops)
        follow_best_reviews(
            spark, stream, twice, follow.root, k=3, columns=COLUMNS, ties=["line"], repeated=True
        ).awaitTermination()
    latest = rows(latest_documents(spark, follow.root), "product_title", "document")
    assert latest == [("P", "P b | a"), ("P2", "P2 b | a")]


def test_products_share_states(spark, tmp_path, rows, monkeypatch):
    """A state holds a group of products: it is called and stored once a group, however small the pieces that arrive."""
    from gleaner.streaming import best_reviews

    monkeypatch.setattr(best_reviews, "TASK_ROWS", 50)
    drops, root = str(tmp_path / "drops"), str(tmp_path / "store")
    meta = spark.range(300).selectExpr("id AS parent_asin", "concat('P', id) AS title", "1.0D AS average_rating")
    reviews = spark.range(3000).selectExpr(
        "id % 300 AS parent_asin", "IF(id % 11 = 0, NULL, concat('t', id)) AS title", "CAST(id % 13 AS DOUBLE) AS helpful_vote", "id AS line"
    )
    for third in range(3):
        reviews.where(F.col("line") % 3 == third).coalesce(1).write.mode("append").parquet(drops)
        stream = spark.readStream.schema(reviews.schema).parquet(drops)
        query = follow_best_reviews(spark, stream, meta, root, k=3, columns=COLUMNS, ties=["line"])
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]
        assert 0 < state["numRowsTotal"] <= best_reviews.LEAST_GROUPS
        monkeypatch.setattr(best_reviews, "GROUP_PRODUCTS", 1)  # the state keeps the groups of its first run
    whole = combine_reviews(reviews, k=3, ties=["line"])
    assert rows(latest_best(spark, root)) == rows(whole)
    assert rows(latest_documents(spark, root)) == rows(documents_from_sources(meta, whole, COLUMNS))
