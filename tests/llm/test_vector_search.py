"""Exact top-k against brute force, with ties, clashes and odd vectors."""

import math
import random

import pytest

from gleaner.llm import vector_search


def brute(rows, k, scale=1024):
    good = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in good:
        if q % 10 == 0:
            near = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 3, 1024])
def test_equals_brute_force(spark, rows, block):
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    data += [(300 + i, data[5][1]) for i in range(40)]  # ties
    data += [(400, None), (410, [1.0, None]), (420, [math.nan] * 6), (430, [math.inf] * 6), (None, [0.0] * 6)]
    data += [(440, [1.0, 2.0]), (441, [3.0, -1.0]), (450, []), (451, []), (460, [1000.0] * 6), (461, [-1000.0] * 6)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    vectors = vector_search.integer_vectors(df, "vec_id", "embedding")
    index = vector_search.build(vectors)
    got = rows(vector_search.top_k(index, vectors.where("id % 10 = 0"), 5, block))
    assert got == sorted(brute(data, 5), key=repr)


def test_fewer_than_k_and_none(spark):
    df = spark.createDataFrame([(10, [1.0]), (11, [2.0])], "vec_id long, embedding array<float>")
    vectors = vector_search.integer_vectors(df, "vec_id", "embedding")
    found = vector_search.top_k(vector_search.build(vectors), vectors.where("id = 10"), 10).collect()
    assert [tuple(r) for r in found] == [(10, 1, 11, 1024 * 2048)]
    none = vectors.where("id < 0")
    assert vector_search.top_k(vector_search.build(none), none).count() == 0


def test_too_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        vector_search.build(vector_search.integer_vectors(df, "vec_id", "embedding"))
