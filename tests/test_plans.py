"""The physical plans that make the operators scale."""

import pytest

from gleaner.operators.dense import embed, hashing_embedder
from gleaner.operators.lexical import build_index
from gleaner.plans import search
from gleaner_queries.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["top_k_reviews", "bm25_search", "knn_l2", "hybrid_rrf"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    text = plan(spark, name)
    partial, final = text.find(", Partial"), text.find(", Final")
    assert "WindowGroupLimit" in text and partial != -1 and final != -1


def test_reviews_are_shuffled_once(spark):
    assert plan(spark, "top_k_reviews").count("Exchange") == 1


def test_documents_need_one_shuffle_per_source(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan(spark, "documents_from_sources").count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scoring_adds_no_shuffle_between_chunk_and_query(spark):
    """Postings go by chunk once; the next exchange carries top-k rows by query."""
    text = plan(spark, "bm25_search")
    main = text[: text.find("Subquery")]
    assert main.count("Exchange hashpartitioning(query_id") == 1
    assert main.count("REPARTITION_BY_COL") == 1


def test_postings_are_built_without_a_shuffle(spark):
    text = plan(spark, "bm25_postings")
    assert "hashpartitioning" not in text and "ArrowEvalPython" not in text


def test_knn_does_not_shuffle_the_corpus(spark):
    text = plan(spark, "knn_l2")
    below = text[text.find("MapInArrow") :]
    assert "Exchange" not in below


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(spark, "top_k_reviews")
    assert "PushedFilters: [IsNotNull(l_partkey)]" in text
    assert "l_tax" not in text.split("ReadSchema")[1]
    assert "text" not in plan(spark, "count_by_category").split("ReadSchema")[1]


def test_equal_queries_are_searched_once(spark, rows, monkeypatch):
    asked = spark.createDataFrame(
        [(1, "a b"), (2, "c"), (3, "a b"), (4, None), (5, None), (None, "c"), (6, "c"), (6, "a"), (7, "a"), (7, "c")],
        "query_id long, query string",
    )
    chunks = spark.createDataFrame([(i, text) for i, text in enumerate(["a b c", "a", "c c", "d"])], "chunk_id long, text string")
    vectors = embed(chunks, "text", hashing_embedder()).select("chunk_id", "embedding")
    corpus = search.Corpus(build_index(chunks), vectors)
    seen = []
    fuse = search._fused
    monkeypatch.setattr(search, "_fused", lambda queries, *rest: seen.append(queries.count()) or fuse(queries, *rest))
    got = search.hybrid_hits(asked, corpus)
    assert seen == [5]  # three texts, and two of the query that asks twice
    assert rows(got) == rows(fuse(asked, corpus, 5, False, None))
