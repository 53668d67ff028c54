import pytest

from gleaner.operators.evaluate import (
    label_precision,
    overlap_at_k,
    recall_at_k,
    rerank,
    rubric_scores,
    side_by_side,
    sweep_recall,
    weight_sweep,
)
from gleaner.operators.fusion import complementary, hybrid, weighted_rrf
from pyspark.sql import functions as F


def hits(spark, *lists):
    rows = [(q, r + 1, c) for q, items in enumerate(lists) for r, c in enumerate(items)]
    return spark.createDataFrame(rows, "query_id int, rank int, chunk_id string")


def ordered(df, column="chunk_id"):
    return [r[column] for r in df.orderBy("query_id", "rank").collect()]


def test_scores_by_hand(spark):
    lexical, semantic = hits(spark, ["a", "b"]), hits(spark, ["b", "c"])
    got = {r["chunk_id"]: r["rrf"] for r in hybrid(lexical, semantic).collect()}
    assert got == pytest.approx({"a": 0.4 / 61, "b": 0.4 / 62 + 0.6 / 61, "c": 0.6 / 62})


def test_default_weights_put_semantic_hits_first(spark):
    lexical, semantic = hits(spark, list("abcde")), hits(spark, list("vwxyz"))
    assert ordered(hybrid(lexical, semantic)) == list("vwxyzabcde")


def test_single_list_keeps_its_order(spark):
    assert ordered(weighted_rrf([(hits(spark, list("cab")), 1.0)])) == list("cab")


def test_ties_go_to_the_first_list(spark):
    a, b = hits(spark, ["x", "y"]), hits(spark, ["p", "q"])
    assert ordered(weighted_rrf([(a, 0.5), (b, 0.5)])) == ["x", "p", "y", "q"]


def test_limit_and_unequal_lengths(spark):
    a, b = hits(spark, ["x"]), hits(spark, ["p", "q", "r"])
    assert ordered(hybrid(a, b)) == ["p", "q", "r", "x"]
    assert ordered(hybrid(a, b, limit_k=2)) == ["p", "q"]


def test_equal_texts_merge_and_count_twice(spark):
    rows = [(0, 1, "c1", "t"), (0, 2, "c2", "t"), (0, 3, "c3", "u")]
    df = spark.createDataFrame(rows, "query_id int, rank int, chunk_id string, text string")
    got = weighted_rrf([(df, 1.0)], id_col="text", carry=["chunk_id"]).orderBy("rank").collect()
    assert [(r["text"], r["chunk_id"]) for r in got] == [("t", "c1"), ("u", "c3")]
    assert got[0]["rrf"] == pytest.approx(1 / 61 + 1 / 62)


def test_complementary():
    assert complementary(0.4) == 0.6


def test_side_by_side_pads_the_shorter_list(spark, rows):
    queries = spark.createDataFrame([(0, "q0")], "query_id int, query string")
    a = hits(spark, ["x", "y"]).withColumnRenamed("chunk_id", "product_title")
    b = hits(spark, ["p"]).withColumnRenamed("chunk_id", "product_title")
    assert rows(side_by_side(queries, a, b)) == [(0, 1, "q0", "x", "p"), (0, 2, "q0", "y", None)]


def test_overlap_and_recall(spark, rows):
    a, b = hits(spark, ["x", "y"], ["x"]), hits(spark, ["y", "z"], ["z"])
    assert rows(overlap_at_k(a, b, 2)) == [(0, 1, 0.5), (1, 0, 0.0)]
    known = spark.createDataFrame([(0, "x"), (0, "n"), (1, "n")], "query_id int, chunk_id string")
    assert rows(recall_at_k(a, known, 2)) == [(0, 2, 1, 0.5), (1, 1, 0, 0.0)]


def test_weight_sweep_agrees_with_single_fusions(spark):
    a, b = hits(spark, list("abc"), list("xy")), hits(spark, list("cde"), list("yz"))
    swept = weight_sweep(a, b, [0.0, 0.4, 1.0])
    for weight in (0.0, 0.4, 1.0):
        assert ordered(swept.where(F.col("bm25_weight") == weight)) == ordered(hybrid(a, b, weight))
    known = spark.createDataFrame([(0, "a"), (1, "none")], "query_id int, chunk_id string")
    recall = {r["bm25_weight"]: r["recall"] for r in sweep_recall(swept, known, 1).collect()}
    assert recall == {0.0: 0.0, 0.4: 0.0, 1.0: 0.5}


def test_rerank_and_label_precision(spark):
    pool = hits(spark, list("abc")).withColumn("boost", F.ascii("chunk_id"))
    assert ordered(rerank(pool, F.col("boost"), 2)) == ["c", "b"]
    assert ordered(rerank(pool, F.lit(1.0))) == ["a", "b", "c"]
    labelled = pool.withColumn("label", F.ascii("chunk_id")).withColumn("query_label", F.lit(97))
    assert label_precision(labelled, 2).first()["precision"] == 0.5


def test_rubric(spark, rows):
    df = spark.createDataFrame([(True, None), (False, True)], "accurate boolean, fluent boolean")
    assert rows(rubric_scores(df, ["accurate", "fluent"])) == [("accurate", 2, 0.5), ("fluent", 1, 1.0)]
