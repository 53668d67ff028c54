import math
import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import lexical
from gleaner.operators.lexical import bm25_scores, bm25_search, build_index, collapse_to_product
from gleaner.sources.index_store import lexical_index



def frames(spark, texts, queries):
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string")
    asked = spark.createDataFrame(list(enumerate(queries or [""])), "query_id long, query string")
    return chunks, asked


def brute_force(texts, queries):
    """Okapi scores of every (query, text) pair, straight from the formula."""
    docs = [t.split() for t in texts]
    n, avgdl = len(docs), sum(map(len, docs)) / len(docs)
    df = {}
    for doc in docs:
        for term in set(doc):
            df[term] = df.get(term, 0) + 1
    idf = {t: math.log(n - f + 0.5) - math.log(f + 0.5) for t, f in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    scores = {}
    for q, query in enumerate(queries):
        for d, doc in enumerate(docs):
            total = 0.0
            for term in query.split():
                tf = doc.count(term)
                total += idf.get(term, 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(doc) / avgdl))
            scores[q, d] = total
    return scores


def corpus(seed=1, size=60):
    rng = random.Random(seed)
    words = ["the"] * 30 + [f"w{i}" for i in range(40)] + ["Case", "case", "end."]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(size)]
    texts += [texts[0], texts[3], "", "  "]
    queries = [" ".join(rng.choices(words + ["unknown"], k=rng.randint(1, 6))) for _ in range(12)]
    return texts, [*queries, "unknown", "the the w1", "Case", " "]


def expected_top(scores, k, padded=False):
    out = []
    for q in sorted({q for q, _ in scores}):
        hits = [(-round(s, 9), d) for (p, d), s in scores.items() if p == q and (padded or s != 0)]
        out += [(q, i + 1, d) for i, (_, d) in enumerate(sorted(hits)[:k])]
    return out


def ids(hits):
    return [tuple(r) for r in hits.select("query_id", "rank", "chunk_id").orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("block", [200_000, 5, 1])
def test_scores_match_brute_force(spark, monkeypatch, block):
    """Broadcast, and sliced with every, some or no term taken as common."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    texts, queries = corpus()
    chunks, asked = frames(spark, texts, queries)
    got = bm25_scores(asked, build_index(chunks)).collect()
    expected = {pair: s for pair, s in brute_force(texts, queries).items() if s != 0}
    assert {(r["query_id"], r["chunk_id"]) for r in got} == set(expected)
    for r in got:
        assert r["score"] == pytest.approx(expected[r["query_id"], r["chunk_id"]], abs=1e-9)


def test_top_k_breaks_ties_by_id(spark):
    texts, queries = corpus()
    chunks, asked = frames(spark, texts, queries)
    hits = bm25_search(asked, build_index(chunks))
    assert ids(hits) == expected_top(brute_force(texts, queries), 5)


def test_smaller_k_is_a_prefix(spark):
    texts, queries = corpus(2)
    chunks, asked = frames(spark, texts, queries)
    index = build_index(chunks)
    assert [h for h in ids(bm25_search(asked, index, 6)) if h[1] <= 3] == ids(bm25_search(asked, index, 3))


def test_padding_fills_with_zero_scores_in_order(spark):
    texts, queries = corpus(3)
    chunks, asked = frames(spark, texts, queries)
    hits = bm25_search(asked, build_index(chunks), 7, pad_to_k=True)
    assert ids(hits) == expected_top(brute_force(texts, queries), 7, padded=True)


def test_padding_with_a_negative_floor(spark):
    """When most terms are common the floor is negative and matches fall behind zeros."""
    texts = ["a b", "a b", "a b c", "b c", "c", "d a b"]
    queries = ["a", "b", "d", "zzz", "a b c d"]
    chunks, asked = frames(spark, texts, queries)
    scores = brute_force(texts, queries)
    assert min(scores.values()) < 0
    index = build_index(chunks)
    assert ids(bm25_search(asked, index, 4, pad_to_k=True)) == expected_top(scores, 4, padded=True)
    # Without padding a hit shares a term with its query, whatever its score.
    shared = {
        (q, d): s for (q, d), s in scores.items() if set(queries[q].split()) & set(texts[d].split())
    }
    assert ids(bm25_search(asked, index, 4)) == expected_top(shared, 4, padded=True)


def test_empty_corpus_has_no_hits(spark):
    chunks, asked = frames(spark, ["", " "], ["a"])
    assert bm25_search(asked, build_index(chunks)).count() == 0


@pytest.mark.parametrize("large", [False, True])
def test_stored_index_gives_the_same_scores(spark, tmp_path, monkeypatch, large):
    texts, queries = corpus(4)
    chunks, asked = frames(spark, texts, queries)
    index = build_index(chunks)
    stored = lexical_index(spark, str(tmp_path), lambda: index, buckets=4)
    if large:
        monkeypatch.setattr(lexical, "BLOCK_TERMS", 3)
    assert ids(bm25_search(asked, stored)) == expected_top(brute_force(texts, queries), 5)


def test_stored_search_reads_only_the_asked_buckets(spark, tmp_path):
    texts, _ = corpus(5)
    chunks, asked = frames(spark, texts, ["w1"])
    stored = lexical_index(spark, str(tmp_path), lambda: build_index(chunks), buckets=8)
    cut = lexical.only_buckets_of(stored, lexical.query_terms(asked))
    assert cut.postings.select("bucket").distinct().count() == 1
    assert cut.terms.where(F.col("term") == "w1").count() == 1


def test_one_term_in_a_third_of_the_postings(spark, monkeypatch):
    """A very common term: one block of queries and several keep every pair."""
    texts = ["hot " * (1 + i % 3) + (f"w{i}" if i % 2 else "") for i in range(300)]
    queries = ["hot", "hot w1", "w3"]
    chunks, asked = frames(spark, texts, queries)
    index = build_index(chunks)
    expected = {pair: s for pair, s in brute_force(texts, queries).items() if s != 0}
    for rows in (200_000, 2):
        monkeypatch.setattr(lexical, "BLOCK_TERMS", rows)
        got = {(r[0], r[1]): r[2] for r in bm25_scores(asked, index).collect()}
        assert got.keys() == expected.keys()
        assert all(got[p] == pytest.approx(expected[p], abs=1e-9) for p in got)


def test_collapse_keeps_the_best_chunk(spark, rows):
    hits = spark.createDataFrame(
        [(0, 1, "a#1", "a"), (0, 2, "b#1", "b"), (0, 3, "a#2", "a"), (1, 1, "b#2", "b")],
        "query_id int, rank int, chunk_id string, parent_asin string",
    )
    got = collapse_to_product(hits)
    assert rows(got, "query_id", "rank", "chunk_id") == [(0, 1, "a#1"), (0, 2, "b#1"), (1, 1, "b#2")]


def test_scoring_tasks_follow_the_pairs(spark, monkeypatch):
    """Every query shares a word with every chunk: the more products, the more tasks hold them."""
    monkeypatch.setattr(lexical, "TASK_PAIRS", 100)
    texts, queries = ["a b"] * 50, ["a", "a b", "b a a", "c"]
    chunks, asked = frames(spark, texts, queries)
    index = lexical.materialised(build_index(chunks))
    assert lexical._scoring_tasks(lexical.query_terms(asked), index) == 3  # 250 products
    scores = bm25_scores(asked, build_index(chunks))
    assert scores.groupBy(F.spark_partition_id()).count().count() == 3
    assert {(r["query_id"], r["chunk_id"]) for r in scores.collect()} == {(q, c) for q in range(3) for c in range(50)}
