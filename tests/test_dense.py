import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import dense
from gleaner.operators.dense import embed, hashing_embedder, knn


def make(spark, n=70, dim=6, seed=0, id_type="long"):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-2, 3, size=(n, dim)).astype(np.float32)  # small integers: many exact ties
    names = list(range(n)) if id_type == "long" else [f"c{i:03d}" for i in range(n)]
    data = [(i, [float(x) for x in v]) for i, v in zip(names, vectors, strict=True)]
    return vectors, names, spark.createDataFrame(data, f"chunk_id {id_type}, embedding array<float>")


def brute_force(queries, vectors, names, k, metric):
    out = []
    for qi, q in enumerate(queries.astype(float)):
        if metric == "l2":
            far = ((vectors.astype(float) - q) ** 2).sum(axis=1)
        else:
            norm = np.linalg.norm(vectors.astype(float), axis=1) * np.linalg.norm(q)
            far = 1 - (vectors.astype(float) @ q) / np.where(norm == 0, 1, norm)
        order = sorted(range(len(names)), key=lambda i: (round(far[i], 9), names[i]))[:k]
        out += [(qi, r + 1, names[i], pytest.approx(far[i], abs=1e-9)) for r, i in enumerate(order)]
    return out


def collect(hits):
    return [tuple(r) for r in hits.orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("id_type", ["long", "string"])
@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("limit", [1000, 7])
def test_exact_top_k_with_ties(spark, metric, limit, id_type):
    vectors, names, corpus = make(spark, id_type=id_type)
    queries = corpus.withColumnRenamed("chunk_id", "name").select(
        (F.substring("name", 2, 3).cast("long") if id_type == "string" else F.col("name")).alias("query_id"),
        "embedding",
    )
    got = collect(knn(queries, corpus.repartition(5), 4, metric, max_query_rows=limit))
    assert got == brute_force(vectors, vectors, names, 4, metric)


def test_copies_of_one_vector_keep_the_smallest_ids(spark):
    """A third of the corpus is one vector: ties at the edge go by id, whichever task holds them."""
    data = [(i, [1.0, 0.0] if i % 3 == 0 else [float(i), 1.0]) for i in range(300)]
    corpus = spark.createDataFrame(data, "chunk_id long, embedding array<float>").repartition(7)
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "query_id long, embedding array<float>")
    assert [r[2] for r in collect(knn(asked, corpus, 5))] == [0, 3, 6, 9, 12]


def test_missing_vectors_and_small_corpora(spark):
    corpus = spark.createDataFrame([(1, [0.0, 1.0]), (2, None)], "chunk_id long, embedding array<float>")
    asked = spark.createDataFrame([(0, [0.0, 1.0]), (1, None)], "query_id long, embedding array<float>")
    for limit in (10, 1):
        assert collect(knn(asked, corpus, 5, max_query_rows=limit)) == [(0, 1, 1, 0.0)]
    none = corpus.where("chunk_id > 5")
    assert knn(asked, none, 5).count() == 0
    assert knn(asked.where("query_id > 5"), corpus, 5).count() == 0


def test_queries_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(dense, "QUERY_BYTES", 9 * 6 * 8)
    vectors, names, corpus = make(spark, seed=3)
    asked = corpus.withColumnRenamed("chunk_id", "query_id")
    assert collect(knn(asked, corpus, 5)) == brute_force(vectors, vectors, names, 5, "l2")


def test_vectors_that_are_not_finite_are_refused(spark):
    corpus = spark.createDataFrame([(1, [float("nan"), 1.0])], "chunk_id long, embedding array<float>")
    asked = spark.createDataFrame([(0, [0.0, 1.0])], "query_id long, embedding array<float>")
    with pytest.raises(Exception, match="not finite"):
        knn(asked, corpus, 5).collect()


def test_self_query_is_first(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(50)]
    corpus = spark.createDataFrame(data, "chunk_id long, embedding array<float>")
    best = knn(corpus.withColumnRenamed("chunk_id", "query_id"), corpus, 1).collect()
    assert all(r["query_id"] == r["chunk_id"] for r in best)


def test_unknown_metric_is_refused(spark):
    _, _, corpus = make(spark)
    with pytest.raises(ValueError):
        dense._Best(np.zeros((1, 2)), 1, "dot")


def test_hashing_embedder(spark):
    df = spark.createDataFrame([(0, "a b a"), (1, ""), (2, None), (3, "a b a")], "id int, text string")
    out = {r["id"]: r["embedding"] for r in embed(df, "text", hashing_embedder(16)).collect()}
    assert np.linalg.norm(out[0]) == pytest.approx(1, abs=1e-6)
    assert sum(out[1]) == sum(out[2]) == 0
    assert out[0] == out[3]


def test_embedder_runs_once_per_text(spark):
    """Search must not evaluate the embedder again for a null check."""
    df = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "chunk_id long, text string")
    vectors = embed(df, "text", lambda: lambda texts: np.ones((len(texts), 3)))
    asked = spark.createDataFrame([(0, [1.0, 1.0, 1.0])], "query_id long, embedding array<float>")
    plan = knn(asked, vectors)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_hashing_embedder_needs_no_python(spark):
    df = spark.createDataFrame([(i, f"t{i} a") for i in range(20)], "chunk_id long, text string")
    plan = embed(df, "text", hashing_embedder(8))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_hashing_embedder_equals_counting(spark):
    import hashlib

    texts = ["a b a", " \t", "x\u2003y  z\nx", "w " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for row in embed(df, "text", hashing_embedder(16)).collect():
        counts = np.zeros(16)
        for token in texts[row["id"]].split():
            counts[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 16] += 1
        assert row["embedding"] == pytest.approx(list(counts / max(1e-9, np.linalg.norm(counts))), abs=1e-6)


@pytest.mark.parametrize("most", [1000, 9])
def test_small_blocks_share_a_scan_and_sets_are_stored(spark, monkeypatch, most):
    """Blocks are cut in the task; only sets of queries beyond the limit need a scan each, stored before the next."""
    monkeypatch.setattr(dense, "QUERY_ROWS", most)
    vectors, names, corpus = make(spark, seed=5)
    asked = corpus.withColumnRenamed("chunk_id", "query_id")
    scans, stored = [], []
    scan, save = dense._knn_scan, dense.saved
    monkeypatch.setattr(dense, "_knn_scan", lambda rows, *rest: scans.append(rows.num_rows) or scan(rows, *rest))
    monkeypatch.setattr(dense, "saved", lambda df: stored.append(1) or save(df))
    got = collect(knn(asked, corpus, 5, max_query_rows=2))
    assert got == brute_force(vectors, vectors, names, 5, "l2")
    assert len(scans) == max(1, -(-corpus.count() // most)) and len(stored) == (len(scans) + 1 if len(scans) > 1 else 0)


def test_far_rows_are_passed_over(monkeypatch):
    rng = np.random.default_rng(0)
    queries, rows = rng.normal(size=(30, 4)), rng.normal(size=(4000, 4))
    merged = []
    merge = dense._Best._merge
    monkeypatch.setattr(dense._Best, "_merge", lambda self, strip, far, ids: merged.append(len(ids)) or merge(self, strip, far, ids))
    best = dense._Best(queries, 5, "l2")
    for start in range(0, 4000, 100):
        best.offer(np.arange(30), np.arange(start, start + 100).astype(object), rows[start : start + 100])
    expected = np.argsort(((queries[:, None] - rows[None]) ** 2).sum(axis=2), axis=1)[:, :5]
    assert best.ids.tolist() == expected.tolist()
    assert sum(merged) < 4000 / 2


@pytest.mark.parametrize("metric, scale", [("l2", 1.0), ("l2", 1e6), ("l2", 1e20), ("cosine", 1.0)])
def test_only_near_pairs_are_ranked(monkeypatch, metric, scale):
    """Once each query has k rows, its far pairs are not ranked; equal distances still go by id."""
    rng = np.random.default_rng(3)
    rows = rng.integers(-3, 4, size=(6000, 6)).astype(float) * scale
    queries = rows[:300]
    ranked = []
    keep, merge = dense._Best._keep, dense._Best._merge
    monkeypatch.setattr(dense._Best, "_keep", lambda self, s, query, *rest: ranked.append(len(query)) or keep(self, s, query, *rest))
    whole = []
    monkeypatch.setattr(dense._Best, "_merge", lambda self, s, far, ids: whole.append(far.size) or merge(self, s, far, ids))
    best = dense._Best(queries, 5, metric)
    for start in range(0, 6000, 1000):
        best.offer(np.arange(300), np.arange(start, start + 1000).astype(object), rows[start : start + 1000])
    if metric == "cosine":
        unit = dense._unit(rows)
        far = 1 - dense._unit(queries) @ unit.T
    else:
        far = ((queries[:, None] - rows[None]) ** 2).sum(axis=2)
    far = np.round(far / (scale**2 if metric == "l2" else 1), 6)
    if scale < 1e15:
        assert best.ids.tolist() == np.argsort(far, axis=1, kind="stable")[:, :5].tolist()
        assert sum(whole) == 300 * dense.FIRST_ROWS
    else:  # no decimals left that could tie
        assert np.round(best.distance / scale**2, 6).tolist() == np.sort(far, axis=1)[:, :5].tolist()


@pytest.mark.parametrize("dim", [16, 64])
def test_hashing_over_batches_equals_the_expression(spark, dim):
    texts = ["a b a", "", None, " \x1cx\u00a0y\u2003z\t", "É 漢字 é", "w " * 300] + [f"word{i} word{i % 7} x" for i in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    one = {r["id"]: r["embedding"] for r in embed(df, "text", hashing_embedder(dim)).collect()}
    made = hashing_embedder(dim).rows(df, "id", "text")
    assert {r["id"]: r["embedding"] for r in made.collect()} == one
    assert "MapInArrow" in made._jdf.queryExecution().executedPlan().toString()
