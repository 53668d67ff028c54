"""Results of costly calls, kept by the hash of what was asked: a later run asks only for what is missing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.answers import Generator, generate
from gleaner.operators.dense import Embedder, HashingEmbedder, embed
from gleaner.operators.ranking import top_k_per_group
from gleaner.sources.writers import saved, write_parquet

PART_ROWS = 100_000


def request_key(*columns: str) -> Column:
    """SHA-256 of the columns' values; a null is a value of its own."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def stored_results(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest result of each request, with its ``request``; None before the first run."""
    try:
        every = spark.read.parquet(f"{root}/results")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return top_k_per_group(every, ["request"], [F.desc("round")], 1, "_newest").drop("_newest", "round")


def complete(
    asked: DataFrame,
    root: str,
    compute: Callable[[DataFrame], DataFrame],
    done: Column | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Results for all requests in ``asked`` (request and what ``compute`` needs), stored under ``root``.

    Requests without a stored result (that is ``done``, if given) are computed, each once however often it is asked, in parts of
    about ``part_rows``; every part is written as a round of its own before the next begins.  A run that dies keeps
    its finished rounds, and an unfinished one is overwritten.  ``compute`` returns request and result columns.
    """
    spark, root = asked.sparkSession, root.rstrip("/")
    known = stored_results(spark, root)
    missing = asked.dropDuplicates(["request"])
    latest = 0
    if known is not None:
        latest = spark.read.parquet(f"{root}/results").agg(F.max("round")).first()[0]
        kept = known if done is None else known.where(done)
        missing = missing.join(kept.select("request"), "request", "left_anti")
    missing = saved(missing)
    parts = -(-missing.count() // part_rows)
    for part in range(parts):
        mine = missing.where(F.pmod(F.xxhash64("request"), F.lit(parts)) == part)
        write_parquet(compute(mine), f"{root}/results/round={latest + 1 + part}")
    found = stored_results(spark, root)
    return saved(compute(missing)) if found is None else found


def generate_missing(
    prompts: DataFrame,
    make_generator: Callable[[str], Generator],
    root: str,
    columns: Sequence[str] = ("query_id",),
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``(*columns, model, prompt, answer, error)`` as :func:`generate` gives it, from a store of answers.

    A model is sent a prompt only if it has not answered it before, or has failed; equal prompts are sent once.
    """
    kept = [*dict.fromkeys([*columns, "model", "prompt"])]
    asked = saved(prompts.select(*kept, request_key("model", "prompt").alias("request")))

    def answer(rows: DataFrame) -> DataFrame:
        return generate(rows, make_generator, ["request"]).select("request", "answer", "error")

    requests = asked.select("request", "model", "prompt")
    answers = complete(requests, root, answer, F.col("error").isNull(), part_rows)
    return asked.join(answers, "request", "left").drop("request")


def embed_missing(
    df: DataFrame,
    text_col: str,
    make_embedder: HashingEmbedder | Callable[[], Embedder],
    root: str,
    vector_col: str = "embedding",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``df`` with its vectors, from a store by text: equal and unchanged texts are embedded once.

    One store holds the vectors of one embedder.  A null text is one request like any other.
    """
    rows = df.withColumn("request", request_key(text_col))

    def vectors(missing: DataFrame) -> DataFrame:
        return embed(missing, text_col, make_embedder, "vector").select("request", "vector")

    known = complete(rows.select("request", text_col), root, vectors, part_rows=part_rows)
    return rows.join(known.withColumnRenamed("vector", vector_col), "request", "left").drop("request")
