"""Registered queries against SQL, and the pipeline's stages against their contracts."""

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import connect, normal
from gleaner.llm import decontaminate, mixing
from gleaner.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    got, expected = QUERIES[name](spark, SF).toPandas(), connect(SF).sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert normal(got) == normal(expected)


def test_registered():
    assert set(QUERIES) < set(queries()) and "pipeline" in queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_keeps_every_row(spark, name):
    table = {"op2_url_filter": "pages", "op13_whitening": "embeddings"}.get(name, "documents")
    per_row = {"op13_whitening": 16}.get(name, 1)
    rows = QUERIES[name](spark, SF)
    if name not in ("op1_decontaminate", "op8_vector_search", "op11_hard_negatives"):
        assert rows.count() == per_row * spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).cache()
        if name != "mixing":
            assert after.columns == columns
            assert after.dtypes == docs.dtypes
        assert after.count() > 0.6 * docs.count()
        docs = after
    sizes = {r[0]: r for r in docs.groupBy("source").agg({"size": "sum"}).collect()}
    assert sizes and docs.where("copies > 2 or copies < 1").count() == 0


def test_pipeline_with_odd_rows(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    odd = [(None, "some words", None, None, None), (900, None, "en", "src1", 0), (901, "", "en", None, 0), (901, "", "en", None, 0)]
    odd += [tuple(rows[3]), (902, rows[4]["text"], None, "src1", None)]
    spark.createDataFrame([*map(tuple, rows), *odd], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_pipeline_leaves_no_leak_and_meets_targets(spark):
    kept = corpus_pipeline.run(spark, SF).cache()
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.leaks(kept, benchmark).count() == 0
    words = kept.withColumn("taken", mixing.word_count("text") * kept.copies)
    for row in words.groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(row["sum(taken)"] - row["max(target)"]) <= 2 * row["max(size)"]
