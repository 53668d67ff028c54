"""Exact BM25 over postings in blocks that know their greatest contribution: blocks that cannot matter are skipped."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.functions.text import Tokeniser, tokenise
from gleaner.operators.lexical import EPSILON, K1, TIE_DECIMALS, TOP_K, B, query_blocks, query_terms, score_order
from gleaner.operators.ranking import top_k_per_group

BLOCK_POSTINGS = 128
# Postings in a batch of blocks, about.
BATCH_POSTINGS = 100_000
# Listed in the filter of the scan up to this many terms; beyond, the broadcast join alone selects them.
PUSHED_TERMS = 2_000
# Up to this many candidates of a shard their postings are chosen; with more, all that can matter are scored.
MOST_CANDIDATES = 1_000_000
# Scores that a task holds at a time, and terms that it multiplies as a matrix at a time.
STRIP_SCORES = 4_000_000
STRIP_TERMS = 64
# A single product, found by its place, takes as long as this many in a product of matrices, about.
DENSE = 16
# Far above the rounding of a sum, and above the width of a tie.
MARGIN = 1e-8


@dataclass(frozen=True)
class BlockIndex:
    """Postings in blocks, and what scores need of the corpus.

    blocks  (segment, shard, term, block, size, max_tf, min_dl, postings)  postings: array of (chunk_id, tf, dl)
    terms   (term, df)                                                     of the live chunks
    dead    (segment, chunk_id)                                            postings to pass over, or None

    A shard holds all postings of its chunks; block 0 of a term has its strongest postings there.
    """

    blocks: DataFrame
    terms: DataFrame
    n: int
    avgdl: float
    avg_idf: float
    dead: DataFrame | None = None


def shard_labels(spark: SparkSession, shards: int) -> list[int]:
    """A number for each shard that a partitioning by it sends to a partition, and a bucket, of its own.

    Numbers from zero up would meet by their hash: a third of the partitions empty, several shards in others.
    """
    tried = 32 * shards
    while True:
        bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(shards))
        rows = spark.range(tried).groupBy(bucket.alias("bucket")).agg(F.min("id").alias("label")).orderBy("bucket").collect()
        if len(rows) == shards:
            return [row["label"] for row in rows]
        tried *= 2


def shard_of(labels: Sequence[int]) -> Column:
    place = F.pmod(F.xxhash64("chunk_id"), F.lit(len(labels))).cast("int")
    return F.get(F.lit(list(labels)).cast("array<int>"), place)


def strength(tf: Column, dl: Column, avgdl: float) -> Column:
    """A posting's share of its term's weight: grows with tf, falls with dl, whatever the average length."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / F.lit(max(avgdl, 1e-300))))


def cut_blocks(postings: DataFrame, shards: int, avgdl: float, size: int = BLOCK_POSTINGS) -> DataFrame:
    """Blocks of ``(chunk_id, dl, term, tf)``, strongest postings first: one shuffle, by shard, and one sort.

    A shard's postings of one term are bounded by the shard's chunks, however common the term is.
    """
    shard = shard_of(shard_labels(postings.sparkSession, shards))
    placed = postings.select(shard.alias("shard"), "term", "chunk_id", "tf", "dl").repartition(shards, "shard")
    # the term leads, as its first bytes tell most rows apart
    order = ["term", "shard", F.desc(strength(F.col("tf"), F.col("dl"), avgdl)), F.asc("chunk_id")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, number = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if left is None else pa.concat_batches([left, batch])
            starts, numbers = _block_starts(rows, number, size)
            # the last block may go on in the next batch
            if len(starts) > 1:
                yield _packed(rows.slice(0, starts[-1]), starts[:-1], numbers[:-1])
            left, number = rows.slice(starts[-1]), numbers[-1]
        if left is not None:
            yield _packed(left, np.zeros(1, np.int32), np.array([number], np.int32))

    return placed.sortWithinPartitions(*order).mapInArrow(cut, _block_schema(postings))


def _block_schema(rows: DataFrame) -> str:
    key = rows.schema["chunk_id"].dataType.simpleString()
    return (
        "shard int, term string, block int, size int, max_tf int, min_dl int, tokens long, "
        f"postings array<struct<chunk_id: {key}, tf: int, dl: int>>"
    )


def cut_bags(bags: DataFrame, shards: int, avgdl: float, size: int = BLOCK_POSTINGS) -> DataFrame:
    """The blocks of ``(chunk_id, dl, terms, tfs)``, as :func:`cut_blocks` gives them for their postings.

    A row a chunk is shuffled instead of a row a posting, and a shard's postings are sorted as numbers.
    """
    shard = shard_of(shard_labels(bags.sparkSession, shards))
    placed = bags.where(F.size("terms") > 0).select(shard.alias("shard"), "chunk_id", "dl", "terms", "tfs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        rows = _sorted_postings(pa.Table.from_batches(parts).combine_chunks(), avgdl)
        del parts
        starts, numbers = _block_starts(rows, 0, size)
        # about as many postings a batch as rows
        edges = np.searchsorted(starts, np.arange(0, rows.num_rows, BATCH_POSTINGS))
        for first, last in zip(edges, np.append(edges[1:], len(starts)), strict=True):
            if first < last:
                end = starts[last] if last < len(starts) else rows.num_rows
                part = rows.slice(starts[first], end - starts[first])
                yield _packed(part, starts[first:last] - starts[first], numbers[first:last])

    return placed.repartition(shards, "shard").mapInArrow(cut, _block_schema(bags))


def _sorted_postings(bags: pa.Table, avgdl: float) -> pa.RecordBatch:
    """``(shard, term, chunk_id, tf, dl)`` in the order that blocks are cut in."""
    shard, ids, dl, terms, tfs = (column.combine_chunks() for column in bags.columns)
    if isinstance(terms, pa.ChunkedArray):  # beyond what offsets of four bytes reach
        raise ValueError("a shard's drop holds more than 2 GB of words")
    coded = terms.flatten().dictionary_encode()
    by_term = pc.sort_indices(coded.dictionary)
    chunk = np.repeat(np.arange(len(ids)), pc.list_value_length(terms).to_numpy())
    tf, length, place = tfs.flatten().to_numpy(), dl.to_numpy()[chunk], shard.to_numpy()[chunk]
    rank = _inverse(by_term.to_numpy())[coded.indices.to_numpy()]
    own = _inverse(pc.sort_indices(ids).to_numpy())[chunk]
    order = np.lexsort((own, -_strength(tf, length, avgdl), place, rank))
    columns = {
        "shard": pa.array(place[order]),
        "term": coded.dictionary.take(by_term).take(pa.array(rank[order])),
        "chunk_id": ids.take(pa.array(chunk[order])),
        "tf": pa.array(tf[order]),
        "dl": pa.array(length[order]),
    }
    return pa.RecordBatch.from_pydict(columns)


def _inverse(order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int32)
    out[order] = np.arange(len(order), dtype=np.int32)
    return out


def _strength(tf: np.ndarray, dl: np.ndarray, avgdl: float) -> np.ndarray:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / max(avgdl, 1e-300)))


def _block_starts(rows: pa.RecordBatch, number: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where blocks start in rows in order, and their numbers; the first row starts block ``number`` of its term."""
    changed = np.zeros(rows.num_rows, bool)
    changed[0] = True
    for column in (rows.column("shard"), rows.column("term")):
        changed[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    runs = np.flatnonzero(changed)
    place = np.arange(rows.num_rows) - np.repeat(runs, np.diff(runs, append=rows.num_rows))
    starts = np.flatnonzero(place % size == 0)
    numbers = place[starts] // size
    if len(runs) > 1:
        numbers[starts < runs[1]] += number
    else:
        numbers += number
    return starts.astype(np.int32), numbers.astype(np.int32)


def _packed(rows: pa.RecordBatch, starts: np.ndarray, numbers: np.ndarray) -> pa.RecordBatch:
    tf, dl = rows.column("tf"), rows.column("dl")
    offsets = pa.array(np.append(starts, rows.num_rows).astype(np.int32))
    entries = pa.StructArray.from_arrays([rows.column("chunk_id"), tf, dl], names=["chunk_id", "tf", "dl"])
    first = pa.array(starts)
    columns = {
        "shard": rows.column("shard").take(first),
        "term": rows.column("term").take(first),
        "block": pa.array(numbers),
        "size": pa.array(np.diff(starts, append=rows.num_rows).astype(np.int32)),
        "max_tf": pa.array(np.maximum.reduceat(tf.to_numpy(), starts)),
        "min_dl": pa.array(np.minimum.reduceat(dl.to_numpy(), starts)),
        "tokens": pa.array(np.add.reduceat(tf.to_numpy(), starts, dtype=np.int64)),
        "postings": pa.ListArray.from_arrays(offsets, entries),
    }
    return pa.RecordBatch.from_pydict(columns)


def live_postings(blocks: DataFrame, dead: DataFrame | None, *columns: str) -> DataFrame:
    """The postings of blocks, beside the named columns; those of dead chunks are left out.

    ``dead`` is bounded by whoever keeps the index (it compacts before), so it is broadcast.
    """
    out = blocks.select("segment", *columns, F.inline("postings"))
    return out if dead is None else out.join(F.broadcast(dead), ["segment", "chunk_id"], "left_anti")


def idf_weights(terms: DataFrame, n: int, avg_idf: float) -> DataFrame:
    plain = F.log(F.lit(n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    return terms.select("term", F.when(plain < 0, F.lit(avg_idf * EPSILON)).otherwise(plain).alias("idf"))


def _asked(wanted: DataFrame, index: BlockIndex) -> tuple[DataFrame, DataFrame]:
    """The blocks of the asked terms, and ``(query_id, term, weight)`` of the terms that the index knows."""
    terms = [row["term"] for row in wanted.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
    names = F.broadcast(wanted.select("term").distinct())
    listed = len(terms) <= PUSHED_TERMS
    blocks = index.blocks.where(F.col("term").isin(terms)) if listed else index.blocks.join(names, "term", "left_semi")
    weights = idf_weights(index.terms.join(names, "term", "left_semi"), index.n, index.avg_idf)
    known = wanted.join(F.broadcast(weights), "term").select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"))
    return blocks, known


@dataclass(frozen=True)
class _Wanted:
    """What a task needs of the queries and of the dead chunks: terms and queries by number, weights by term."""

    query_ids: pa.Array
    terms: pa.Array
    query: np.ndarray  # sorted by term
    term: np.ndarray
    weight: np.ndarray
    dead: dict[str, pa.Array]
    avgdl: float

    @classmethod
    def of(cls, asked: DataFrame, index: BlockIndex) -> _Wanted:
        rows = asked.toArrow().combine_chunks()
        query, term = (_coded(rows.column(name)) for name in ("query_id", "term"))
        order = np.argsort(term.indices.to_numpy(), kind="stable")
        weight = rows.column("weight").to_numpy()[order]
        dead = {}
        if index.dead is not None:
            marked = index.dead.select("segment", "chunk_id").toArrow()
            by_segment = _coded(marked.column("segment"))
            for number, segment in enumerate(by_segment.dictionary.to_pylist()):
                own = marked.column("chunk_id").filter(pc.equal(by_segment.indices, number))
                dead[segment] = pa.concat_arrays(own.chunks)
        return cls(
            query.dictionary, term.dictionary, query.indices.to_numpy()[order], term.indices.to_numpy()[order], weight, dead, index.avgdl
        )


def _coded(column: pa.ChunkedArray) -> pa.DictionaryArray:
    return pa.concat_arrays(column.chunks or [pa.array([], column.type)]).dictionary_encode("encode")


class _Shard:
    """The live postings of a shard's blocks, with their terms and chunks by number."""

    def __init__(self, blocks: pa.Table, wanted: _Wanted):
        self.wanted = wanted
        known = pc.index_in(blocks.column("term"), wanted.terms)
        blocks, known = blocks.filter(known.is_valid()), known.drop_null()
        sizes = pc.list_value_length(blocks.column("postings")).to_numpy()
        entries = pa.concat_arrays([chunk.flatten() for chunk in blocks.column("postings").chunks] or [pa.array([], _entry(blocks))])
        ids = entries.field("chunk_id").dictionary_encode("encode")
        self.ids, chunk = ids.dictionary, ids.indices.to_numpy()
        block = np.repeat(np.arange(len(sizes)), sizes)
        live = self._live(blocks.column("segment"), ids, block)
        self.block_term = known.to_numpy().astype(np.int32)
        self.first = (blocks.column("block").to_numpy() == 0)
        self.top = _strength(blocks.column("max_tf").to_numpy(), blocks.column("min_dl").to_numpy(), wanted.avgdl)
        self.block, self.chunk = block[live], chunk[live]
        tf, dl = (entries.field(name).to_numpy()[live] for name in ("tf", "dl"))
        self.strength = _strength(tf, dl, wanted.avgdl)
        self.term = self.block_term[self.block]
        # an id that repeats has more than one posting of a term
        pair = np.sort(self.term.astype(np.int64) * max(len(self.ids), 1) + self.chunk)
        runs = np.diff(np.flatnonzero(np.diff(pair, prepend=-1)), append=len(pair))
        self.repeats = int(runs.max(initial=1))

    def _live(self, segments: pa.ChunkedArray, ids: pa.DictionaryArray, block: np.ndarray) -> np.ndarray:
        live = np.ones(len(block), bool)
        if not self.wanted.dead:
            return live
        named = segments.to_numpy()
        for segment, dead in self.wanted.dead.items():
            gone = pc.is_in(ids.dictionary, dead, skip_nulls=True).to_numpy(zero_copy_only=False)
            live &= ~(gone[ids.indices.to_numpy()] & (named == segment)[block])
        return live


def _entry(blocks: pa.Table) -> pa.DataType:
    return blocks.schema.field("postings").type.value_type


class _Scores:
    """Scores of a strip of queries for all chunks of a shard, and which pairs share a term."""

    def __init__(self, shard: _Shard, strip: slice):
        wanted = shard.wanted
        self.shard, self.queries = shard, strip.stop - strip.start
        own = (wanted.query >= strip.start) & (wanted.query < strip.stop)
        self.query, self.term, self.weight = wanted.query[own] - strip.start, wanted.term[own], wanted.weight[own]
        self.sum = np.zeros((self.queries, len(shard.ids)))
        # with weights above zero, a pair shares a term if its sum is
        self.met = None if (self.weight > 0).all() else np.zeros(self.sum.shape, bool)
        self.scored = np.zeros(self.queries, np.int64)

    def add(self, postings: np.ndarray) -> None:
        """Multiply the named postings with all queries that ask their term."""
        shard = self.shard
        postings = postings[np.argsort(shard.term[postings], kind="stable")]
        terms, starts = np.unique(shard.term[postings], return_index=True)
        stops = np.append(starts[1:], len(postings))
        low, high = np.searchsorted(self.term, terms), np.searchsorted(self.term, terms, "right")
        common = (high - low) * (stops - starts) * DENSE > self.sum.size
        columns = np.flatnonzero(common)
        for few in np.split(columns, np.arange(STRIP_TERMS, len(columns), STRIP_TERMS)):
            self._add_common(postings, [(starts[t], stops[t], low[t], high[t]) for t in few])
        for start, stop, one, end in zip(*(x[~common] for x in (starts, stops, low, high)), strict=True):
            if one == end:
                continue
            rows, query = postings[start:stop], self.query[one:end]
            self.scored[query] += stop - start
            part = self.weight[one:end, None] * shard.strength[rows]
            if shard.repeats > 1:
                np.add.at(self.sum, np.ix_(query, shard.chunk[rows]), part)
            else:
                self.sum[np.ix_(query, shard.chunk[rows])] += part
            if self.met is not None:
                self.met[np.ix_(query, shard.chunk[rows])] = True

    def _add_common(self, postings: np.ndarray, spans: list[tuple[int, int, int, int]]) -> None:
        """Terms that many queries ask and many chunks hold, as one product of matrices."""
        if not spans:
            return
        shard = self.shard
        weights, held = np.zeros((self.queries, len(spans))), np.zeros((len(spans), len(shard.ids)))
        for number, (start, stop, one, end) in enumerate(spans):
            rows = postings[start:stop]
            held[number] = np.bincount(shard.chunk[rows], shard.strength[rows], len(shard.ids))
            weights[self.query[one:end], number] = self.weight[one:end]
            self.scored[self.query[one:end]] += stop - start
            if self.met is not None:
                self.met[np.ix_(self.query[one:end], shard.chunk[rows])] = True
        self.sum += weights @ held

    def reached(self, k: int) -> np.ndarray:
        """What the best k of each query reach at least; nothing is known where weights may be negative."""
        if (self.weight < 0).any() or self.sum.shape[1] < k:
            return np.full(self.queries, -np.inf)
        kth = np.partition(self.sum, -k, axis=1)[:, -k]
        return np.where(kth > 0, kth - MARGIN, -np.inf)

    def bounds(self) -> np.ndarray:
        """What a term gives a chunk at most, beside each asked term."""
        tops = np.zeros(len(self.shard.wanted.terms))
        np.maximum.at(tops, self.shard.block_term, self.shard.top)
        return np.maximum(0, self.weight) * tops[self.term] * self.shard.repeats

    def best(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, chunk, score)`` of the k best of each query, ties to the smaller id."""
        met = self.sum > 0 if self.met is None else self.met
        keys = np.where(met, np.round(self.sum, TIE_DECIMALS), -np.inf)
        k = min(k, keys.shape[1])
        edge = np.partition(keys, -k, axis=1)[:, -k]
        query, chunk = np.nonzero(met & (keys >= edge[:, None]))
        some, place = np.unique(chunk, return_inverse=True)
        by_id = _inverse(pc.array_sort_indices(self.shard.ids.take(pa.array(some)), null_placement="at_start").to_numpy())[place]
        order = np.lexsort((by_id, -keys[query, chunk], query))
        query, chunk = query[order], chunk[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < k
        return query[keep], chunk[keep], self.sum[query[keep], chunk[keep]]


def _scored(shard: _Shard, strip: slice, k: int) -> _Scores:
    """The scores of the best k of each query, and lower ones for chunks that are not among them."""
    scores = _Scores(shard, strip)
    first = shard.first[shard.block]
    scores.add(np.flatnonzero(first))
    reached, bound = scores.reached(k), scores.bounds()
    # A term whose weaker ones, and itself, stay below what is reached cannot bring a chunk there alone.
    order = np.lexsort((scores.term, bound, scores.query))
    sums = np.cumsum(bound[order])
    starts = np.searchsorted(scores.query[order], scores.query[order])
    upto = np.empty(len(order))
    upto[order] = sums - (sums[starts] - bound[order][starts])
    every = np.bincount(scores.query, bound, scores.queries)
    essential = upto * (1 + MARGIN) >= reached[scores.query]
    # A block matters if it can bring a chunk there for one of its queries, with all their other terms.
    with np.errstate(divide="ignore", invalid="ignore"):
        least = (reached - every * (1 + MARGIN))[scores.query] + bound
        least = np.where(least <= 0, 0, least / (np.maximum(scores.weight, 0) * shard.repeats))
    need = np.full(len(shard.wanted.terms), np.inf)
    np.minimum.at(need, scores.term, least)
    rest = ~first & (shard.top >= need[shard.block_term])[shard.block]
    needed = np.zeros(len(need), bool)
    needed[scores.term[essential]] = True
    now = needed[shard.term]
    scores.add(np.flatnonzero(rest & now))
    others = np.bincount(scores.query, np.where(needed[scores.term], 0, bound), scores.queries)
    near = scores.sum + (others * (1 + MARGIN))[:, None] >= reached[:, None]
    late = rest & ~now
    if np.count_nonzero(near) <= MOST_CANDIDATES:
        late &= near.any(axis=0)[shard.chunk]
    scores.add(np.flatnonzero(late))
    return scores


def _strips(shard: _Shard) -> Iterator[slice]:
    queries = len(shard.wanted.query_ids)
    width = max(1, STRIP_SCORES // max(len(shard.ids), 1))
    for start in range(0, queries, width):
        yield slice(start, min(start + width, queries))


def _scores(blocks: DataFrame, asked: DataFrame, index: BlockIndex, k: int = TOP_K) -> DataFrame:
    """``(query_id, chunk_id, score)`` of each shard's best k for each query, made where the shard's blocks are read."""
    wanted = _Wanted.of(asked, index)
    key, query = index.blocks.schema["postings"].dataType.elementType["chunk_id"], asked.schema["query_id"]
    ids = to_arrow_type(key.dataType)

    def score(rows: pa.Table) -> pa.Table:
        shard = _Shard(rows, wanted)
        found = [pa.table({"query_id": wanted.query_ids[:0], "chunk_id": pa.array([], ids), "score": pa.array([], pa.float64())})]
        for strip in _strips(shard) if len(shard.chunk) else ():
            own, chunk, sums = _scored(shard, strip, k).best(k)
            named = {"query_id": wanted.query_ids.take(pa.array(own + strip.start)), "chunk_id": shard.ids.take(pa.array(chunk))}
            found.append(pa.table({**named, "score": pa.array(sums)}))
        return pa.concat_tables(found)

    schema = f"query_id {query.dataType.simpleString()}, chunk_id {key.dataType.simpleString()}, score double"
    return _by_shard(blocks).applyInArrow(score, schema)


def _by_shard(blocks: DataFrame):
    return blocks.select("segment", "shard", "term", "block", "max_tf", "min_dl", "postings").groupBy("shard")


def pruned_search(
    queries: DataFrame, index: BlockIndex, k: int = TOP_K, tokeniser: Tokeniser = tokenise
) -> DataFrame:
    """Top-k chunks of each query as ``(query_id, rank, chunk_id, score)``, the same as the full search gives.

    A task has the asked blocks of a shard, which holds all postings of its chunks.  First the strongest block of each
    term gives a score that the shard's best k reach.  A chunk among them holds an essential term, and each of its
    blocks must be able to give what the query's other terms cannot give at most; blocks that fail are skipped.  Chunks
    that, with all that the remaining terms can add, get there are candidates, and only their postings of those terms -
    the common ones - are multiplied with queries.  Where candidates are many, choosing costs more than it spares, and
    all those terms' blocks that can matter are scored.  Blocks are stored by shard, so nothing but k rows a query and
    shard moves.
    """
    found = []
    for wanted in query_blocks(query_terms(queries, tokeniser)):
        blocks, asked = _asked(wanted, index)
        found.append(top_k_per_group(_scores(blocks, asked, index, k), ["query_id"], score_order(), k))
    return reduce(DataFrame.unionByName, found).select("query_id", "rank", "chunk_id", "score")


def pruned_share(queries: DataFrame, index: BlockIndex, k: int = TOP_K, tokeniser: Tokeniser = tokenise) -> DataFrame:
    """``(query_id, postings, scored)``: live postings of a query's terms, and how many of them a search multiplies with it."""
    found = []
    for block in query_blocks(query_terms(queries, tokeniser)):
        blocks, asked = _asked(block, index)
        found.append(_shares(blocks, _Wanted.of(asked, index), asked, k))
    rows = reduce(DataFrame.unionByName, found)
    return rows.groupBy("query_id").agg(F.sum("postings").alias("postings"), F.sum("scored").alias("scored"))


def _shares(blocks: DataFrame, wanted: _Wanted, asked: DataFrame, k: int) -> DataFrame:
    def count(rows: pa.Table) -> pa.Table:
        shard = _Shard(rows, wanted)
        held = np.bincount(shard.term, minlength=len(wanted.terms))
        every = np.bincount(wanted.query, held[wanted.term], len(wanted.query_ids)).astype(np.int64)
        scored = [_scored(shard, strip, k).scored for strip in _strips(shard)] if len(shard.chunk) else [np.zeros_like(every)]
        return pa.table({"query_id": wanted.query_ids, "postings": pa.array(every), "scored": pa.array(np.concatenate(scored))})

    return _by_shard(blocks).applyInArrow(count, f"query_id {asked.schema['query_id'].dataType.simpleString()}, postings long, scored long")
