import pytest
from pyspark.sql import functions as F

from gleaner.operators import answers, guards
from gleaner.operators.profiling import counts_by, distinct_values, nan_to_null, table_profile
from gleaner.operators.ranking import order_by_rating


@pytest.fixture
def queries(spark):
    return spark.createDataFrame([(0, "first?"), (1, "second?")], "query_id int, query string")


def test_context_in_rank_order_and_empty(spark, queries):
    hits = spark.createDataFrame(
        [(0, 2, "B2", "Two", None, "t2"), (0, 1, "B1", None, 4.5, "t1")],
        "query_id int, rank int, parent_asin string, product_title string, average_rating double, text string",
    )
    ready = answers.with_context(queries, answers.context_by_query(hits)).orderBy("query_id").collect()
    assert ready[0]["context"] == (
        "Product ASIN: B1\nTitle: N/A\nAverage Rating: 4.5\nContent: t1\n"
        "\n\n"
        "Product ASIN: B2\nTitle: Two\nAverage Rating: N/A\nContent: t2\n"
    )
    assert ready[1]["context"] == ""
    short = answers.context_by_query(hits, titles_only=True).first()["context"]
    assert short == "Product ASIN: B1\nTitle: \n\n\nProduct ASIN: B2\nTitle: Two\n"


def test_prompt_forms(spark, queries):
    row = queries.select(
        answers.chat_prompt(F.lit("SYS"), F.lit("CTX"), F.col("query")).alias("chat"),
        answers.full_prompt(F.lit("SYS"), F.lit("CTX"), F.col("query"), "END").alias("full"),
    ).first()
    assert row["chat"] == "SYS\n\ncontext:\nCTX\n\nquestion:\nfirst?"
    assert row["full"] == "SYS\n\ncontext:\nCTX\n\nquestion:\nfirst?\n\nEND"
    prompts = queries.sparkSession.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "prompt_id string, system_text string")
    assert answers.prompt_table(queries, prompts).count() == 2 * 3
    assert answers.prompt_table(queries, prompts.limit(0)).count() == 0


def test_one_failure_costs_one_answer(spark, queries):
    def make(model):
        def generate(prompts):
            if any("second" in p for p in prompts):
                raise RuntimeError("quota")
            return [f"{model}: {p}" for p in prompts]

        return generate

    prompts = answers.per_model(queries.withColumn("prompt", F.col("query")), ["m1", "m2"]).coalesce(1)
    got = {(r["query_id"], r["model"]): (r["answer"], r["error"]) for r in answers.generate(prompts, make).collect()}
    assert got == {
        (0, "m1"): ("m1: first?", None),
        (0, "m2"): ("m2: first?", None),
        (1, "m1"): ("Error: quota", "quota"),
        (1, "m2"): ("Error: quota", "quota"),
    }


def test_models_that_fail_cost_their_rows_only(spark, queries):
    def make(model):
        if model in ("broken", None):
            raise RuntimeError("no model")
        return lambda prompts: prompts[1:] if model == "short" else prompts

    prompts = answers.per_model(queries.withColumn("prompt", F.col("query")), ["ok", "short", "broken", None]).coalesce(1)
    got = {(r["query_id"], r["model"]): r["error"] for r in answers.generate(prompts, make).collect()}
    assert got == {(q, m): e for q in (0, 1) for m, e in (
        ("ok", None), ("short", "0 answers for 1 prompts"), ("broken", "no model"), (None, "no model"))}


def test_model_comparison(spark, rows):
    df = spark.createDataFrame(
        [(0, "q", "a", "<think>x</think> one"), (0, "q", "b", "two")],
        "query_id int, query string, model string, answer string",
    )
    wide = answers.compare_models(answers.clean_answers(df), ["a", "b"])
    assert wide.columns == ["query_id", "query", "a's response", "b's response"]
    assert rows(wide) == [(0, "q", "one", "two")]
    assert answers.answer_table(df).columns == ["query", "Output Response"]


def test_guards(spark, rows, queries):
    blanks = spark.createDataFrame([(0, " a "), (1, "\t\n"), (2, None)], "query_id int, query string")
    assert rows(guards.drop_blank_queries(blanks)) == [(0, "a")]
    found = spark.createDataFrame([(0, "yes")], "query_id int, answer string")
    assert rows(guards.with_message(queries, found, "answer", guards.NO_ANSWER)) == [
        (0, "first?", "yes"),
        (1, "second?", guards.NO_ANSWER),
    ]
    titles = spark.createDataFrame([("t",), (None,)], "product_title string")
    assert rows(guards.with_title_default(titles)) == [("Unknown Product",), ("t",)]
    hits = spark.createDataFrame([(0, "x"), (0, "y")], "query_id int, chunk_id string")
    assert rows(guards.hits_per_query(hits, "BM25")) == [(0, "BM25", 2, "Top 2 results — BM25 mode")]


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, "a", float("nan")), (2, None, 1.0), (3, "a", None)], "i int, s string, d double")
    assert rows(table_profile(nan_to_null(df))) == [(3, "d", "double", 1), (3, "i", "int", 3), (3, "s", "string", 2)]
    assert [tuple(r) for r in counts_by(df, "s").collect()] == [("a", 2), (None, 1)]
    assert rows(distinct_values(df, "s")) == [("a",), (None,)]


def test_order_by_rating(spark):
    df = spark.createDataFrame(
        [(0, 1, "a", None), (0, 2, "b", 3.0), (0, 3, "c", 4.0)],
        "query_id int, rank int, chunk_id string, average_rating double",
    )
    assert [r["chunk_id"] for r in order_by_rating(df).orderBy("rank").collect()] == ["c", "b", "a"]
