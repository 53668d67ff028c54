"""Stored answers and vectors: only what is missing or failed is asked again."""

import random

import numpy as np
from pyspark.sql import functions as F

from gleaner.session import work_dir
from gleaner.sources import result_store as store

SCHEMA = "query_id long, model string, prompt string"
ROWS = [(1, "a", "one"), (2, "a", "bad two"), (3, "b", "one"), (4, "a", "one"), (5, None, "one"), (6, "a", None)]


def makers():
    """Two generators' factories; nested, so that they travel to the workers by value."""

    def careful(model):
        """Fails where the prompt is bad or missing; every call has an answer of its own."""

        def answer(prompts):
            if any(p is None or "bad" in p for p in prompts):
                raise ValueError("no")
            return [f"{model} {random.random()}" for _ in prompts]

        return answer

    return careful, lambda model: lambda prompts: [f"again {model}" for _ in prompts]


def test_second_run_asks_only_for_failures(spark):
    root, (careful, willing) = work_dir(spark), makers()
    prompts = spark.createDataFrame(ROWS, SCHEMA)
    one = {r["query_id"]: r for r in store.generate_missing(prompts, careful, root).collect()}
    assert [k for k, r in sorted(one.items()) if r["error"]] == [2, 6]
    assert one[1]["answer"] == one[4]["answer"] != one[3]["answer"]  # equal requests are sent once
    more = prompts.union(spark.createDataFrame([(7, "b", "new")], SCHEMA))
    two = {r["query_id"]: r for r in store.generate_missing(more, willing, root).collect()}
    assert len(two) == 7 and not any(r["error"] for r in two.values())
    assert all(two[k]["answer"] == one[k]["answer"] for k in (1, 3, 4, 5))
    assert (two[2]["answer"], two[6]["answer"], two[7]["answer"]) == ("again a", "again a", "again b")
    three = {r["query_id"]: r["answer"] for r in store.generate_missing(more, careful, root).collect()}
    assert three == {k: r["answer"] for k, r in two.items()}


def test_finished_parts_survive(spark):
    root = work_dir(spark)
    prompts = spark.createDataFrame([(i, "a", f"p{i}") for i in range(20)], SCHEMA)
    asked = prompts.withColumn("request", store.request_key("model", "prompt"))
    calls = []

    def compute(rows):
        calls.append(rows.count())
        if len(calls) == 3:
            raise RuntimeError("lost")
        return rows.select("request", F.lit("x").alias("answer"))

    try:
        store.complete(asked, root, compute, part_rows=5)
    except RuntimeError:
        pass
    kept = sum(calls[:2])
    assert store.stored_results(spark, root).count() == kept
    assert store.complete(asked, root, compute, part_rows=100).count() == 20 and calls[3] == 20 - kept


def test_texts_are_embedded_once(spark):
    root = work_dir(spark)

    def make():
        return lambda texts: np.random.default_rng().random((len(texts), 3))

    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "")], "id long, text string")
    one = {r["id"]: r["embedding"] for r in store.embed_missing(df, "text", make, root).collect()}
    assert one[1] == one[2] != one[3] and len(one) == 5 and one[4] != one[5]
    more = df.union(spark.createDataFrame([(6, "z")], df.schema))
    two = {r["id"]: r["embedding"] for r in store.embed_missing(more, "text", make, root).collect()}
    assert {k: two[k] for k in one} == one and len(two[6]) == 3


def test_nothing_asked(spark):
    root, (careful, _) = work_dir(spark), makers()
    none = spark.createDataFrame([], SCHEMA)
    assert store.generate_missing(none, careful, root).count() == 0
    assert store.generate_missing(spark.createDataFrame(ROWS[:1], SCHEMA), careful, root).count() == 1
    assert store.generate_missing(none, careful, root).count() == 0
