"""Embeddings and exact nearest neighbours."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StructField, StructType

from gleaner.functions.text import tokenise
from gleaner.operators.ranking import top_k_per_group
from gleaner.sources.writers import saved

Embedder = Callable[[list[str]], np.ndarray]

TOP_K = 5
TIE_DECIMALS = 9
# Queries a task may hold (rows, and bytes as doubles), and queries compared at a time.
QUERY_ROWS = 20_000
QUERY_BYTES = 64 << 20
QUERY_STRIP = 256
ROW_STRIP = 2048
# Rows that are ranked whole until every query of a strip has k.
FIRST_ROWS = 256
# Of a sum of single-precision products, for each of its parts; and up to which length of vectors they are taken.
ROUNDING, LONGEST = 2.0**-23, 1e15


@dataclass(frozen=True)
class HashingEmbedder:
    """Model-free embedder: unit-length counts of hashed white-space tokens, as a native expression."""

    dim: int = 64

    def column(self, text: Column) -> Column:
        # One letter a token names its bucket; a bucket's count is what its letter's removal takes away.
        first = 0x30 if self.dim <= 0x4E else 0x4E00  # one byte a letter if they suffice
        letters = [chr(first + b) for b in range(self.dim)]
        alphabet = F.array(*map(F.lit, letters))

        def letter(token: Column) -> Column:
            number = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long")
            return F.get(alphabet, (number % self.dim).cast("int"))

        line = F.array_join(F.transform(tokenise(F.coalesce(text, F.lit(""))), letter), "")
        # Through a lambda's argument, so that the line is made once for all letters.
        counts = F.transform(
            F.array(line),
            lambda s: F.transform(alphabet, lambda c: (F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double")),
        )
        sized = F.transform(counts, lambda v: F.struct(v.alias("counts"), _norm(v).alias("norm")))
        unit = F.transform(sized, lambda s: F.transform(s["counts"], lambda c: (c / s["norm"]).cast("float")))
        return F.get(unit, F.lit(0))


    def rows(self, df: DataFrame, id_col: str, text_col: str, vector_col: str = "embedding") -> DataFrame:
        """``(id_col, vector_col)``, the same vectors as of :meth:`column`, over Arrow batches: a word is hashed once a batch."""
        dim, id_type = self.dim, df.schema[id_col].dataType.simpleString()
        words = df.select(id_col, tokenise(F.col(text_col)).alias("w"))

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts = _bucket_counts(batch.column(1), dim)
                length = np.sqrt((counts**2).sum(axis=1, keepdims=True))
                unit = (counts / np.where(length == 0, 1.0, length)).astype(np.float32)
                offsets = pa.array(np.arange(0, unit.size + 1, dim, dtype=np.int32))
                columns = {id_col: batch.column(0), vector_col: pa.ListArray.from_arrays(offsets, pa.array(unit.ravel()))}
                yield pa.RecordBatch.from_pydict(columns)

        return words.mapInArrow(vectors, f"`{id_col}` {id_type}, `{vector_col}` array<float>")


def _bucket_counts(words: pa.Array, dim: int) -> np.ndarray:
    coded = words.flatten().dictionary_encode()
    # as bytes, whatever they hold
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    buckets = np.array([int.from_bytes(hashlib.md5(name, usedforsecurity=False).digest()[:4], "big") % dim for name in names], np.int64)
    row = np.repeat(np.arange(len(words)), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
    place = row * dim + buckets[coded.indices.to_numpy()]
    return np.bincount(place, minlength=len(words) * dim).reshape(len(words), dim).astype(np.float64)


def _norm(counts: Column) -> Column:
    length = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda total, c: total + c * c))
    return F.when(length == 0, F.lit(1.0)).otherwise(length)


def embed(
    df: DataFrame,
    text_col: str,
    make_embedder: HashingEmbedder | Callable[[], Embedder],
    vector_col: str = "embedding",
) -> DataFrame:
    """Add an ``array<float>`` column.

    The hashing embedder is an expression.  Any other is made once per task and gets the
    texts in Arrow batches.
    """
    if isinstance(make_embedder, HashingEmbedder):
        return df.withColumn(vector_col, make_embedder.column(F.col(text_col)))

    def embed_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embedder = make_embedder()
        for texts in batches:
            vectors = embedder(texts.fillna("").tolist())
            yield pd.Series(list(np.asarray(vectors, dtype=np.float32)))

    return df.withColumn(vector_col, F.pandas_udf(embed_batches, "array<float>")(text_col))


def hashing_embedder(dim: int = 64) -> HashingEmbedder:
    return HashingEmbedder(dim)


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    metric: str = "l2",
    vector_col: str = "embedding",
    max_query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """Exact top-k as ``(query_id, rank, chunk_id, distance)``, nearest first.

    ``l2`` is the squared distance, ``cosine`` one minus the cosine.  Queries travel to
    every corpus task in sets of bounded rows and bytes; a task compares ``max_query_rows``
    of them at a time at most and returns its k best per query, so the corpus is scanned
    once a set and never shuffled.  Where there are several sets, the hits of one are stored
    before the next is fetched: the driver holds one at a time.  A vector with a component
    that is not finite is an error.
    """
    asked = queries.select("query_id", vector_col)
    stored = corpus.select("chunk_id", vector_col)
    schema = StructType(
        [asked.schema["query_id"], stored.schema["chunk_id"], StructField("distance", DoubleType())]
    )
    strip = max(1, min(QUERY_STRIP, max_query_rows))
    head = asked.limit(QUERY_ROWS + 1).toArrow()
    if head.num_rows <= QUERY_ROWS and 2 * head.nbytes <= QUERY_BYTES:
        best = _knn_scan(head, stored, k, metric, schema, strip)
    else:
        del head
        found = [saved(_knn_scan(rows, stored, k, metric, schema, strip)) for rows in _query_sets(asked)]
        best = reduce(DataFrame.unionByName, found)
    order = [F.round("distance", TIE_DECIMALS).asc(), F.asc("chunk_id")]
    return top_k_per_group(best, ["query_id"], order, k).select(
        "query_id", "rank", "chunk_id", "distance"
    )


def _query_sets(asked: DataFrame) -> Iterator[pa.Table]:
    """The queries in tables of about ``QUERY_ROWS`` and ``QUERY_BYTES``."""
    stored = saved(asked)
    wide = stored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(asked.columns[1])).alias("cells")).first()
    sets = max(-(-wide["n"] // QUERY_ROWS), -(-8 * (wide["cells"] or 0) // QUERY_BYTES))
    for number in range(sets):
        yield stored.where(F.pmod(F.xxhash64("query_id"), F.lit(sets)) == number).toArrow()


def _knn_scan(rows: pa.Table, stored: DataFrame, k: int, metric: str, schema: StructType, strip: int) -> DataFrame:
    query_ids, query_vectors = _vectors(rows.column(0), rows.column(1))
    arrow_schema = _arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(query_vectors, k, metric, strip)
        for batch in batches:
            best.add(batch.column(0), batch.column(1))
        yield from best.batches(query_ids, arrow_schema)

    return stored.mapInArrow(scan, schema)


def _arrow_schema(schema: StructType) -> pa.Schema:
    return pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])


def _vectors(
    ids: pa.Array | pa.ChunkedArray, vectors: pa.Array | pa.ChunkedArray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a matrix of the rows that have a vector.

    Missing vectors go here and not in a filter before: a filter on a column made by
    an embedder would run the embedder twice.
    """
    present = vectors.is_valid()
    ids, vectors = ids.filter(present), vectors.filter(present)
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.isfinite(flat).all():
        raise ValueError("a vector holds a component that is not finite")
    width = len(flat) // len(vectors) if len(vectors) else 0
    return np.asarray(ids.to_pylist(), dtype=object), flat.reshape(len(vectors), width)


class _Best:
    """The k nearest rows seen so far for each query; ties go to the smaller id."""

    def __init__(self, queries: np.ndarray, k: int, metric: str, strip: int = QUERY_STRIP):
        if metric not in ("l2", "cosine"):
            raise ValueError(f"unknown metric {metric!r}")
        self.k, self.strip = k, strip
        self.cosine = metric == "cosine"
        self.queries = _unit(queries) if self.cosine else queries
        self.square = (self.queries**2).sum(axis=1)
        self.coarse = self.queries.astype(np.float32) if self.square.max(initial=0) < LONGEST**2 else self.queries
        self.distance = np.full((len(queries), k), np.inf)
        self.ids = np.full((len(queries), k), None, dtype=object)

    def add(self, ids: pa.Array, vectors: pa.Array) -> None:
        new_ids, rows = _vectors(ids, vectors)
        self.offer(np.arange(len(self.queries)), new_ids, rows)

    def offer(self, asked: np.ndarray, new_ids: np.ndarray, rows: np.ndarray) -> None:
        """Compare the queries at the given places with rows."""
        if not len(rows) or not len(asked):
            return
        if self.cosine:
            rows = _unit(rows)
        square = (rows**2).sum(axis=1)
        # Strips of queries and of rows bound the distance matrix held at any time, to what a core keeps at hand.
        for start in range(0, len(asked), self.strip):
            strip = asked[start : start + self.strip]
            first = 0
            while first < len(rows):
                full = np.isfinite(self.distance[strip, -1]).all()
                these = slice(first, first + (ROW_STRIP if full else FIRST_ROWS))
                self._compare(strip, new_ids[these], rows[these], square[these])
                first = these.stop

    def _compare(self, strip: np.ndarray, new_ids: np.ndarray, rows: np.ndarray, square: np.ndarray) -> None:
        own = self.square[strip]
        # Rows that are beyond the k-th of a query, by more than a tie's width, change nothing for it.
        edge = self.distance[strip, -1] + 10.0 ** -(TIE_DECIMALS - 1)
        if not np.isfinite(edge).all() or square.max() >= LONGEST**2:
            self._merge(strip, self._far(self.queries[strip] @ rows.T, own[:, None], square[None, :]), new_ids)
            return
        # First by products of low precision, with room for their rounding; the few pairs left get their distance.
        dots = self.coarse[strip] @ rows.astype(self.coarse.dtype).T
        error = ROUNDING * (rows.shape[1] + 8) * (own + square.max() + edge)
        if self.cosine:
            least = 1 - edge - error
        else:
            least = (own - edge) / 2 - error
            dots -= (square / 2).astype(dots.dtype)
        place = np.flatnonzero(dots >= least.astype(dots.dtype)[:, None])
        query, column = place // len(rows), place % len(rows)
        near = np.einsum("ij,ij->i", self.queries[strip[query]], rows[column])
        far = self._far(near, own[query], square[column])
        held = far <= edge[query]
        query, column, far = query[held], column[held], far[held]
        if not len(query):
            return
        some, query = np.unique(query, return_inverse=True)
        strip = strip[some]
        before = np.repeat(np.arange(len(some)), self.k)
        distance = np.concatenate([self.distance[strip].ravel(), far])
        ids = np.concatenate([self.ids[strip].ravel(), new_ids[column]])
        self._keep(strip, np.concatenate([before, query]), distance, np.round(distance, TIE_DECIMALS), ids)

    def _far(self, dots: np.ndarray, own: np.ndarray, square: np.ndarray) -> np.ndarray:
        return 1 - dots if self.cosine else np.maximum(own + square - 2 * dots, 0)

    def _merge(self, strip: np.ndarray, far: np.ndarray, new_ids: np.ndarray) -> None:
        both = np.hstack([self.distance[strip], far])
        keys = np.round(both, TIE_DECIMALS)
        edge = np.partition(keys, self.k - 1, axis=1)[:, self.k - 1]
        query, column = np.nonzero((keys <= edge[:, None]) & np.isfinite(keys))
        held = column < self.k
        ids = np.empty(len(column), dtype=object)
        ids[held] = self.ids[strip][query[held], column[held]]
        ids[~held] = new_ids[column[~held] - self.k]
        self._keep(strip, query, both[query, column], keys[query, column], ids)

    def _keep(self, strip: np.ndarray, query: np.ndarray, distance: np.ndarray, key: np.ndarray, ids: np.ndarray) -> None:
        """The first k of each query's pairs, which hold those it had."""
        _, id_order = np.unique(ids, return_inverse=True)
        order = np.lexsort((id_order, key, query))
        query, distance, ids = query[order], distance[order], ids[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        query, distance, ids, place = query[keep], distance[keep], ids[keep], place[keep]
        self.distance[strip] = np.inf
        self.distance[strip[query], place] = distance
        self.ids[strip[query], place] = ids

    def batches(self, query_ids: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(query_ids), 10_000):
            strip = slice(start, start + 10_000)
            query, place = np.nonzero(np.isfinite(self.distance[strip]))
            columns = [
                query_ids[strip][query],
                self.ids[strip][query, place],
                self.distance[strip][query, place],
            ]
            arrays = [pa.array(c.tolist(), type=f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.where(norms == 0, 1, norms)
