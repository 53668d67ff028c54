"""Okapi BM25 over chunk tables: index tables and batch search."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import Tokeniser, tokenise
from gleaner.operators.ranking import top_k_per_group, with_rank
from gleaner.sources.writers import saved, with_row_index

# The usual Okapi constants, and the default number of hits.
K1, B, EPSILON = 1.5, 0.75, 0.25
TOP_K = 5
# Scores closer than this many decimals count as tied; the chunk id then decides.
TIE_DECIMALS = 9
# Rows of query terms that are scored (and broadcast) at a time.
BLOCK_TERMS = 200_000
# Products of a posting with a query that a task sums up, about.
TASK_PAIRS = 1_000_000


@dataclass(frozen=True)
class LexicalIndex:
    """Tables of a lexical index.

    postings  (chunk_id, dl, term, tf)    one row per chunk and distinct term
    terms     (term, df, ctf)             one row per term
    corpus    (n, avgdl, avg_idf)         one row
    chunks    (chunk_id, text, ...)       the indexed rows

    A stored index also has ``bucket`` on postings and terms, a hash of the term
    that names the folder, and ``buckets``, their number, on corpus.
    """

    postings: DataFrame
    terms: DataFrame
    corpus: DataFrame
    chunks: DataFrame

    @classmethod
    def from_terms(cls, postings: DataFrame, terms: DataFrame, chunks: DataFrame) -> LexicalIndex:
        """Derive the corpus row from the term table and the number of chunks."""
        n = chunks.agg(F.count(F.lit(1)).alias("n")).scalar()
        corpus = (
            terms.select("ctf", _plain_idf(n, F.col("df")).alias("idf0"))
            .agg(F.sum("ctf").alias("tokens"), F.avg("idf0").alias("avg_idf"))
            .select(
                n.alias("n"),
                (F.coalesce("tokens", F.lit(0)) / F.greatest(n, F.lit(1))).alias("avgdl"),
                F.coalesce("avg_idf", F.lit(0.0)).alias("avg_idf"),
            )
        )
        return cls(postings, terms, corpus, chunks)

    @property
    def stored(self) -> bool:
        return "bucket" in self.postings.columns


def build_postings(chunks: DataFrame, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """Term frequencies counted inside each row, so no token is ever shuffled.

    The sorted tokens of a chunk are cut into runs of equal terms; a run's length
    is the term frequency.
    """
    words = chunks.select("chunk_id", F.sort_array(tokeniser(F.col("text"))).alias("w"))
    size = F.size("w")
    starts = F.filter(
        F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.col("w")[i] != F.col("w")[i - 1])
    )
    no_starts = F.array().cast("array<int>")
    cut = words.select(
        "chunk_id", "w", size.alias("dl"), F.when(size > 0, starts).otherwise(no_starts).alias("s")
    )
    ends = F.concat(F.slice("s", F.lit(2), F.size("s")), F.array("dl"))
    runs = cut.select("chunk_id", "dl", "w", "s", ends.alias("e"))
    entries = F.transform(
        "s", lambda start, i: F.struct(F.col("w")[start].alias("term"), (F.col("e")[i] - start).alias("tf"))
    )
    # Only the id and the length go beside the exploded runs; the token array must not
    # be copied to every posting.
    return runs.select("chunk_id", "dl", F.explode(entries).alias("p")).select(
        "chunk_id", "dl", "p.term", "p.tf"
    )


def build_bags(chunks: DataFrame, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """``(chunk_id, dl, terms, tfs)``: a chunk's postings in one row, counted over Arrow batches."""
    key = chunks.schema["chunk_id"].dataType.simpleString()
    words = chunks.select("chunk_id", tokeniser(F.col("text")).alias("w"))
    return words.mapInArrow(_count_words, f"chunk_id {key}, dl int, terms array<string>, tfs array<int>")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(1)
        dl = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        width = max(len(coded.dictionary), 1)
        place = np.repeat(np.arange(batch.num_rows), dl) * width + coded.indices.to_numpy()
        held, tfs = np.unique(place, return_counts=True)
        offsets = pa.array(np.searchsorted(held, np.arange(batch.num_rows + 1) * width).astype(np.int32))
        terms = coded.dictionary.take(pa.array(held % width))
        columns = {
            "chunk_id": batch.column(0),
            "dl": pa.array(dl.astype(np.int32)),
            "terms": pa.ListArray.from_arrays(offsets, terms),
            "tfs": pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32))),
        }
        yield pa.RecordBatch.from_pydict(columns)


def _plain_idf(n: Column, df: Column) -> Column:
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def build_index(chunks: DataFrame, tokeniser: Tokeniser = tokenise) -> LexicalIndex:
    """Lazy index tables; the only shuffle is the partially aggregated count per term."""
    postings = build_postings(chunks, tokeniser)
    return LexicalIndex.from_terms(postings, _count_terms(postings), chunks)


def _count_terms(postings: DataFrame) -> DataFrame:
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("long").alias("ctf"))


def _floored_idf(idf0: Column, avg_idf: Column) -> Column:
    """A term in more than half the chunks gets a fraction of the average instead."""
    return F.when(idf0 < 0, avg_idf * EPSILON).otherwise(idf0)


def term_weights(index: LexicalIndex) -> DataFrame:
    """``(term, df, idf)`` of the whole vocabulary."""
    n = index.corpus.select("n").scalar()
    avg_idf = index.corpus.select("avg_idf").scalar()
    return index.terms.select(
        "term", "df", _floored_idf(_plain_idf(n, F.col("df")), avg_idf).alias("idf")
    )


def asked_weights(index: LexicalIndex, asked: DataFrame) -> DataFrame:
    """``(term, idf, avgdl)`` of the terms in ``asked(term)``, a set of bounded size, that the corpus holds."""
    weights = term_weights(index).join(F.broadcast(asked), "term", "left_semi")
    return weights.select("term", "idf", index.corpus.select("avgdl").scalar().alias("avgdl"))


def query_terms(queries: DataFrame, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """``(query_id, term, qtf)``: repeats in the query count."""
    tokens = queries.select("query_id", F.explode(tokeniser(F.col("query"))).alias("term"))
    return tokens.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def term_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")


def only_buckets_of(index: LexicalIndex, wanted: DataFrame) -> LexicalIndex:
    """A stored index cut down to the folders that can hold the wanted terms."""
    buckets = index.corpus.first()["buckets"]
    found = [row["b"] for row in wanted.select(term_bucket(buckets).alias("b")).distinct().collect()]
    inside = F.col("bucket").isin(found)
    return replace(index, postings=index.postings.where(inside), terms=index.terms.where(inside))


def query_blocks(wanted: DataFrame, rows: int | None = None) -> list[DataFrame]:
    """The query terms cut by query into blocks of about ``rows`` rows, so that a block can be broadcast."""
    blocks = -(-wanted.count() // (rows or BLOCK_TERMS))
    if blocks <= 1:
        return [wanted]
    return [wanted.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b) for b in range(blocks)]


def materialised(index: LexicalIndex) -> LexicalIndex:
    """The index with its postings and terms in scratch tables, so that the text is tokenised once."""
    postings = saved(index.postings)
    terms = saved(_count_terms(postings))
    return LexicalIndex.from_terms(postings, terms, index.chunks)


def bm25_scores(queries: DataFrame, index: LexicalIndex, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """``(query_id, chunk_id, score)`` for each pair that shares a term.

    Queries are taken block by block.  The postings of a block's terms are shuffled once
    by chunk, before they multiply with the queries; scoring and the first top-k cut
    then stay local, so a query's pairs with all chunks never move.  The shuffle has as
    many partitions as the products need, which are counted before: by the size of the
    postings alone a task would get the more pairs to hold, the more queries share a term.
    """
    if not index.stored:
        index = materialised(index)
    found = [_block_scores(block, index) for block in query_blocks(query_terms(queries, tokeniser))]
    return reduce(DataFrame.unionByName, found)


def _block_scores(wanted: DataFrame, index: LexicalIndex) -> DataFrame:
    if index.stored:
        index = only_buckets_of(index, wanted)
    idf = asked_weights(index, wanted.select("term").distinct())
    tf, dl = F.col("tf"), F.col("dl")
    part = F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.col("avgdl")))
    matched = index.postings.join(F.broadcast(idf), "term").select("chunk_id", "term", part.alias("part"))
    tasks = _scoring_tasks(wanted, index)
    dealt = matched.repartition(tasks, "chunk_id") if tasks > 1 else matched.repartition("chunk_id")
    pairs = dealt.join(F.broadcast(wanted), "term")
    return pairs.groupBy("query_id", "chunk_id").agg(F.sum(F.col("qtf") * F.col("part")).alias("score"))


def _scoring_tasks(wanted: DataFrame, index: LexicalIndex) -> int:
    """Tasks over which the products of postings and queries are spread."""
    askers = wanted.groupBy("term").agg(F.count(F.lit(1)).alias("askers"))
    met = index.terms.join(F.broadcast(askers), "term").agg(F.sum(F.col("df") * F.col("askers")).alias("pairs"))
    return -(-(met.first()["pairs"] or 0) // TASK_PAIRS)


def score_order(score: str = "score", id_col: str = "chunk_id") -> list[Column]:
    return [F.round(score, TIE_DECIMALS).desc(), F.asc(id_col)]


def bm25_search(
    queries: DataFrame,
    index: LexicalIndex,
    k: int = TOP_K,
    tokeniser: Tokeniser = tokenise,
    pad_to_k: bool = False,
) -> DataFrame:
    """Top-k chunks of each query as ``(query_id, rank, chunk_id, score)``.

    By default a hit shares a term with its query.  ``pad_to_k`` ranks every chunk,
    so unmatched ones follow with score zero in chunk order.
    """
    scores = bm25_scores(queries, index, tokeniser)
    if pad_to_k:
        scores = _with_zero_scores(queries, scores, index, k)
    ranked = top_k_per_group(scores, ["query_id"], score_order(), k)
    return ranked.select("query_id", "rank", "chunk_id", "score")


def _with_zero_scores(queries: DataFrame, scores: DataFrame, index: LexicalIndex, k: int) -> DataFrame:
    """Add the first k unmatched chunks of every query with fewer than k positive hits.

    With the chunks numbered in id order, a matched chunk at place p with m matched ones
    before it has p - m unmatched ones before it.  The j-th unmatched chunk therefore lies
    at j plus the number of matched chunks with at most j unmatched ones before them: k
    counts a query, however many chunks it matched.
    """
    scores = saved(scores)
    chunks = with_row_index(index.chunks.select("chunk_id"), ["chunk_id"], "place")
    positive = F.count_if(F.col("score") > 0).alias("positive")
    short = (
        queries.select("query_id")
        .join(scores.groupBy("query_id").agg(positive), "query_id", "left")
        .where(F.coalesce("positive", F.lit(0)) < k)
        .select("query_id")
    )
    matched = scores.join(short, "query_id", "left_semi").join(chunks, "chunk_id")
    before = with_rank(matched, ["query_id"], [F.asc("place")], "nth").select(
        "query_id", (F.col("place") - F.col("nth") + 1).alias("free")
    )
    counts = before.groupBy("query_id").agg(
        F.array(*[F.count_if(F.col("free") <= j) for j in range(k)]).alias("shift")
    )
    none = F.array_repeat(F.lit(0).cast("long"), k)
    places = short.join(counts, "query_id", "left").select(
        "query_id", F.posexplode(F.coalesce("shift", none)).alias("j", "shift")
    )
    unmatched = places.select("query_id", (F.col("j") + F.col("shift")).alias("place")).join(chunks, "place")
    return scores.unionByName(unmatched.select("query_id", "chunk_id", F.lit(0.0).alias("score")))


def hit_fields(hits: DataFrame) -> DataFrame:
    """The display fields of hits joined to their chunks, score as a double."""
    return hits.select(
        "query_id",
        "rank",
        "parent_asin",
        "product_title",
        "average_rating",
        F.col("score").cast("double").alias("score"),
    )


def collapse_to_product(hits: DataFrame, key: str = "parent_asin") -> DataFrame:
    """Keep the best-ranked chunk of each product and number the rest anew."""
    best = top_k_per_group(hits, ["query_id", key], [F.asc("rank")], 1, "_pick").drop("_pick")
    return with_rank(best.withColumnRenamed("rank", "_old"), ["query_id"], [F.asc("_old")]).drop("_old")
