"""Nearest neighbours by cells against plain distances."""

import random

import numpy as np
import pytest

from gleaner.operators import cells, dense
from gleaner.session import work_dir

SCHEMA = "chunk_id long, embedding array<float>"


def clustered(dice, n, dim=6, groups=8):
    middle = [[dice.uniform(-5, 5) for _ in range(dim)] for _ in range(groups)]
    return [(i, [m + dice.gauss(0, 0.3) for m in middle[i % groups]]) for i in range(n)]


def brute(queries, rows, k):
    out = []
    for q, v in queries:
        if v is None:
            continue
        at = np.array(v, np.float32).astype(float)
        near = sorted((round(float(((at - np.array(w, np.float32).astype(float)) ** 2).sum()), 9), i) for i, w in rows if w)
        out += [(q, rank + 1, i, round(d, 6)) for rank, (d, i) in enumerate(near[:k])]
    return sorted(out)


def found(spark, queries, index, k, **options):
    asked = spark.createDataFrame(queries, "query_id long, embedding array<float>")
    return sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["distance"], 6)) for r in cells.knn_cells(asked, index, k, **options).collect())


@pytest.fixture(scope="module")
def data():
    dice = random.Random(6)
    rows = clustered(dice, 600)
    return rows + [(1000 + i, rows[3][1]) for i in range(30)] + [(2000, None)]  # ties, and a row without a vector


def test_equals_brute_force_and_skips_cells(spark, data):
    index = cells.build_cells(spark.createDataFrame(data, SCHEMA), work_dir(spark), 16)
    queries = [(i, v) for i, v in data[:40]] + [(50, None), (51, [100.0] * 6), (52, [0.0] * 6)]
    assert found(spark, queries, index, 5) == brute(queries, data, 5)
    assert found(spark, queries, index, 5, query_rows=7) == brute(queries, data, 5)
    near = spark.createDataFrame(data[:40], "query_id long, embedding array<float>")
    assert cells.cells_read(near, index, 5) < 0.4


def test_only_needed_folders_are_read(spark, data):
    index = cells.build_cells(spark.createDataFrame(data, SCHEMA), work_dir(spark), 16)
    _, vectors = dense._vectors(*(c for c in spark.createDataFrame(data[:1], SCHEMA).toArrow().columns))
    found, meet = cells._search_block(index, vectors, 3)
    plan = found._jdf.queryExecution().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "cell" in filters[: filters.index("]")]
    assert meet.sum() < len(index.size)


def test_more_asked_than_there_is(spark, data):
    index = cells.build_cells(spark.createDataFrame(data[:4], SCHEMA), work_dir(spark), 16)
    assert found(spark, data[:2], index, 9) == brute(data[:2], data[:4], 9)
    same = cells.build_cells(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], SCHEMA), work_dir(spark), 4)
    assert [r[2] for r in found(spark, [(1, [0.0, 0.0])], same, 3)] == [0, 1, 2]


def test_nothing_stored_or_asked(spark, data):
    none = cells.build_cells(spark.createDataFrame([], SCHEMA), work_dir(spark), 4)
    assert found(spark, data[:2], none, 3) == []
    some = cells.build_cells(spark.createDataFrame(data[:9], SCHEMA), work_dir(spark), 4)
    assert found(spark, [], some, 3) == []
