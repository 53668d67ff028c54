"""One query per operator over the whole of its table, and SQL where it can express the result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import (
    context_mixing,
    decontaminate,
    hard_negatives,
    jaccard,
    language,
    mixing,
    quality,
    secrets,
    sentences,
    token_counts,
    url_filter,
    vector_search,
    whitening,
)
from gleaner.llm.common import fold

RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
SOURCE_WEIGHTS = [3.0, 1.0, 2.0]
VOCABULARY_VARIABLE = "GLEANER_VOCABULARY"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The byte-pair vocabulary to count with: a path that every executor can read, settable by environment."""
    return os.environ.get(VOCABULARY_VARIABLE, "/opt/tokenizers/byte_bpe_50k.tiktoken")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.example_urls(spark))
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), "url", RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict", "blocked_score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = sentences.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", "n_sentences", "n_removed")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), jaccard.Similarity(n=3, share=90, parts=100))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    mixed = mixing.mix(sized, SOURCE_WEIGHTS, share=1.5, most=2.0)
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source"
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    content = language.dictionaries(documents.where(fold("doc_id", 4) != 2))
    found = language.identify(documents.select("doc_id", "text"), content)
    return found.select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_margin").alias("margin"),
        F.col("lang_rejected").alias("rejected"),
    )


def derived_edits(documents: DataFrame) -> DataFrame:
    """Three edits of every document, placed by hashes of its id: a replacement, an insertion and a deletion.

    The new words are the document's own language and source, so the table grows with the documents.
    """

    def place(salt: int, span: F.Column) -> F.Column:
        return F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.greatest(span, F.lit(1)))

    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    own = F.concat_ws(" ", "lang", "source", F.col("doc_id").cast("string"))
    rows = documents.select("doc_id", length.alias("n"), own.alias("own"))
    first, second, third = (place(k, F.col("n")) for k in (1, 2, 3))
    edits = F.array(
        F.struct(F.lit(1).alias("seq"), first.alias("start"), (first + place(4, F.lit(40))).alias("end"), F.col("own").alias("new")),
        F.struct(F.lit(2).alias("seq"), second.alias("start"), second.alias("end"), F.concat(F.lit(" "), "own", F.lit(".\n")).alias("new")),
        F.struct(F.lit(3).alias("seq"), third.alias("start"), (third + place(5, F.lit(200))).alias("end"), F.lit("").alias("new")),
    )
    return rows.select("doc_id", F.inline(edits))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    counted = token_counts.count_edited(documents, derived_edits(documents), vocabulary_path())
    return counted.drop("edited_text")


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_search.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return vector_search.top_k(vector_search.build(vectors), vectors.where("id % 100 = 0"), k=10)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = table(spark, sf_dir, "labels").where(fold("doc_id", 3) != 1).select("doc_id", "quality")
    model = quality.train(documents, known)
    scored = quality.score(documents, model)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


def op10_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = (fold("doc_id", 7) != 2).alias("learn")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", learn, F.col("lang").alias("group"))
    scored = context_mixing.score(documents)
    return scored.select(
        "doc_id",
        F.coalesce(fold("doc_id", 7) == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "bits_per_byte",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    embeddings = table(spark, sf_dir, "embeddings").withColumn("label", label)
    rows = hard_negatives.integer_rows(embeddings, "vec_id", "embedding", "label")
    return hard_negatives.mine(rows, rows.where("id % 100 = 0"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(documents, secrets.train(documents))
    kinds = F.col("base_spans")["kind"]

    def count(kind: str) -> Column:
        return F.size(F.filter(kinds, lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(secrets.digest("base_spans"), 256).alias("base_sha256"),
        secrets.digest("spans").alias("spans"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.integer_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_url_filter,
        op3_substring_dedup,
        op4_jaccard_join,
        op5_mix_sources,
        op6_language_id,
        op7_token_counts,
        op8_vector_search,
        op9_quality,
        op10_context_mixing,
        op11_hard_negatives,
        op12_secret_scan,
        op13_whitening,
    )
}

ORACLE: dict[str, str] = {}

ORACLE["op8_vector_search"] = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op11_hard_negatives"] = """
WITH vectors AS (
    SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END) AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM vectors a JOIN vectors c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN scored n
  ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 30 * positive_score <= 100 * n.score AND 100 * n.score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE["op4_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    END AS s
    FROM docs
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM items a JOIN items b
      ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), edges AS (
    SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs
    UNION
    SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
), named AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, n.component_id FROM sets s JOIN named n USING (doc_id)
"""

ORACLE["op3_substring_dedup"] = r"""
WITH cut AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS parts FROM documents
), split AS (
    SELECT doc_id, text, parts, list_transform(parts, lambda p: list_filter(string_split_regex(
        translate(p, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
    FROM cut
), counted AS (
    SELECT doc_id, i, n, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto, upto - n AS before
    FROM (SELECT doc_id, generate_subscripts(words, 1) AS i, len(unnest(words)) AS n FROM split)
), spans AS (
    SELECT a.doc_id, a.i AS first, b.i AS last
    FROM (SELECT * FROM counted WHERE n > 0) a
    ASOF JOIN (SELECT * FROM counted WHERE n > 0) b ON a.doc_id = b.doc_id AND a.before + 20 <= b.upto
    UNION
    SELECT a.doc_id, b.i, a.i
    FROM (SELECT * FROM counted WHERE n > 0) a
    ASOF JOIN (SELECT * FROM counted WHERE n > 0) b ON a.doc_id = b.doc_id AND a.upto - 20 >= b.before
), contents AS (
    SELECT doc_id, first, last, md5(array_to_string(list_transform(list_filter(words[first:last], lambda w: len(w) > 0),
        lambda w: array_to_string(w, ' ')), chr(10))) AS content
    FROM spans JOIN split USING (doc_id)
), again AS (
    SELECT doc_id, first, last FROM (
        SELECT *, min(doc_id) OVER (PARTITION BY content) AS origin,
               row_number() OVER (PARTITION BY doc_id, content ORDER BY first, last) AS nth FROM contents)
    WHERE origin <> doc_id OR nth > 1
), gone AS (
    SELECT doc_id, list_distinct(flatten(list(range(first, last + 1)))) AS covered FROM again GROUP BY doc_id
)
SELECT doc_id, CASE WHEN covered IS NULL THEN text ELSE array_to_string(
           list_filter(parts, lambda p, i: NOT list_contains(covered, i)), '') END AS text,
       coalesce(len(parts), 0)::INTEGER AS n_sentences, coalesce(len(covered), 0)::INTEGER AS n_removed
FROM split LEFT JOIN gone USING (doc_id)
"""
