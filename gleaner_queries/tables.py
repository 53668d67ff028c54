"""The driver tables in the roles of products, reviews, corpus, queries and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.dense import embed, hashing_embedder
from gleaner.operators.lexical import LexicalIndex, build_index
from gleaner.plans.search import Corpus
from gleaner.plans.sizing import spread_scan

KEY = "parent_asin"
TIES = ["l_orderkey", "l_linenumber"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem: quantity stands for votes; order key and line break the ties."""
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias(KEY),
        F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("title"),
        F.col("l_quantity").alias("helpful_vote"),
        *TIES,
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    """part: with an array and a map built from its columns."""
    size = F.col("p_size").cast("string")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias(KEY),
        F.col("p_type").alias("main_category"),
        F.col("p_name").alias("title"),
        F.array("p_brand", F.when(F.col("p_size") > 25, size)).alias("features"),
        F.split("p_name", " ").alias("description"),
        F.when(
            F.col("p_type") != "PROMO",
            F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), size),
        ).alias("details"),
        F.col("p_retailprice").alias("average_rating"),
    )


def corpus_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spread_scan(table(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text"))


def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in which lines that end with a certain letter end a paragraph."""
    rows = table(spark, sf, "documents")
    text = F.replace("text", F.lit("e.\n"), F.lit("e.\n\n"))
    return spread_scan(rows.select("doc_id", "source", text.alias("text")))


def described_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a title and a rating; about half of them have no rating."""
    documents = table(spark, sf, "documents").withColumnRenamed("doc_id", "chunk_id")
    ratings = table(spark, sf, "labels").select(
        F.col("doc_id").alias("chunk_id"), F.col("quality").cast("double").alias("average_rating")
    )
    return documents.join(ratings, "chunk_id", "left").select(
        "chunk_id",
        F.col("chunk_id").alias(KEY),
        F.concat_ws("/", "source", "lang").alias("product_title"),
        "average_rating",
        "text",
    )


def query_set(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def index(spark: SparkSession, sf: str) -> LexicalIndex:
    return build_index(corpus_rows(spark, sf))


def corpus(spark: SparkSession, sf: str, described: bool = False) -> Corpus:
    rows = described_rows(spark, sf) if described else corpus_rows(spark, sf)
    bare = corpus_rows(spark, sf)
    built = build_index(bare)
    vectors = embed(bare, "text", hashing_embedder()).select("chunk_id", "embedding")
    return Corpus(LexicalIndex(built.postings, built.terms, built.corpus, rows), vectors)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding", "label")


def marked_answers(spark: SparkSession, sf: str) -> DataFrame:
    """conversations, wrapped in the markers that clean-up has to find."""
    text = F.col("text")
    think = F.concat(F.lit("<think>plan\n"), text, F.lit("</think>\n  "), text)
    twice = F.concat(think, F.lit(" <think>again</think> end "))
    reply = F.concat(F.lit("Human: hi\nAssistant: "), text, F.lit(" Assistant: bye\t"))
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "assistant", think)
        .when(F.col("role") == "user", twice)
        .otherwise(text)
        .alias("reasoned"),
        F.when(F.col("role") == "assistant", reply).otherwise(text).alias("replied"),
    )
