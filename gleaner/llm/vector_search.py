"""Exact top-k by inner product over a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import saved

CELLS = 256
QUERY_BLOCK = 1024
FLOAT_EXACT = float(1 << 53)
CHUNK = 2048


def integer_vectors(df: DataFrame, id_column: str, vector: str, scale: int = 1024) -> DataFrame:
    """``id`` and ``v``, the floor of scale times each component, for rows with an id and a finite vector.

    Rows whose id or vector is null, or whose vector holds a null or a non-finite component, take no part.
    Components whose scaled value leaves the range of a 32-bit integer are not finite numbers of this index
    and raise an error.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c * scale))
    return df.select(F.col(id_column).cast("long").alias("id"), F.when(finite, scaled).alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
    )


def build(vectors: DataFrame) -> DataFrame:
    """The approximation file: id, dim, one byte per component (its cell) and the exact vector, stored together.

    Cells divide the span from the least to the greatest component of the whole table evenly.  Readers of the
    cells do not read the exact vectors, which are a column of their own.
    """
    span = vectors.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    low, high = span["low"] or 0, span["high"] or 0
    if max(abs(low), abs(high)) >= 1 << 31:
        raise ValueError("scaled components must fit 32 bits")
    width = max(1, -(-(high - low + 1) // CELLS))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            dims = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
            ends = np.cumsum(dims)
            cells, exact = ((values - low) // width).astype(np.uint8), values.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(dims),
                    pa.array([cells[e - d : e].tobytes() for d, e in zip(dims, ends)], pa.binary()),
                    pa.array([exact[e - d : e].tobytes() for d, e in zip(dims, ends)], pa.binary()),
                ],
                ["id", "dim", "cells", "exact"],
            )

    stored = saved(vectors.mapInArrow(encode, "id long, dim int, cells binary, exact binary"))
    return stored.withMetadata("cells", {"low": low, "width": width})


def _matrix(column: pa.Array, dtype, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), dim)


class _Bounds:
    """Upper and lower bounds of inner products of a query block with cell vectors."""

    def __init__(self, queries: np.ndarray, low: int, width: int):
        self.queries = queries.astype(np.float64)
        self.low, self.width = low, width
        self.slack = np.abs(self.queries).sum(axis=1) * ((width - 1) / 2)

    def __call__(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle = self.low + self.width * cells.astype(np.float64) + (self.width - 1) / 2
        centre = self.queries @ middle.T
        # rounding of the sums stays far below this margin
        slack = self.slack[:, None] + 1e-9 * (1 + np.abs(centre))
        return centre - slack, centre + slack


def _exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; through floating point where that is exact."""
    top = float(np.abs(query).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(len(query), 1)
    if top < FLOAT_EXACT:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return vectors.astype(np.int64) @ query.astype(np.int64)


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k rows of greatest inner product for each query: query_id, rank, vec_id, score.

    ``queries`` has id and v.  A row whose id is the query's id is no candidate.  Ties go to the smaller id;
    rows repeated with the same id are candidates one by one.  A query meets only vectors of its own length.
    Fewer than k candidates: all are returned; an empty index or query set: no rows.

    Queries are taken in blocks of bounded size.  For each block one scan of the cells yields, per query, the
    kth best lower bound of all rows; a second scan reads cells again and, in the order of their bounds, only
    the exact vectors whose upper bound reaches it, until the kth result of the task is certain.  Tasks return
    at most k rows a query.
    """
    meta = index.schema["cells"].metadata
    numbered = saved(queries.select("id", "v", F.size("v").alias("dim")))
    blocks: list[DataFrame] = []
    for dim in sorted(r["dim"] for r in numbered.select("dim").distinct().collect()):
        mine = numbered.where(F.col("dim") == dim)
        count = mine.count()
        parts = -(-count // query_block)
        for part in range(parts):
            block = mine.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part) if parts > 1 else mine
            rows = [(r["id"], r["v"]) for r in block.collect()]
            if rows:
                blocks.append(_one_block(index.where(F.col("dim") == dim), rows, dim, k, meta["low"], meta["width"]))
    schema = "query_id long, rank int, vec_id long, score long"
    if not blocks:
        return index.sparkSession.createDataFrame([], schema)
    found = blocks[0]
    for more in blocks[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _one_block(
    index: DataFrame, rows: list[tuple[int, list[int]]], dim: int, k: int, low: int, width: int
) -> DataFrame:
    ids = np.array([r[0] for r in rows], np.int64)
    vectors = np.array([r[1] for r in rows], np.int64).reshape(len(rows), dim)
    names = [f"{i}:{n}" for n, i in enumerate(ids)]

    def lower_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, best = _Bounds(vectors, low, width), np.full((len(ids), 0), -np.inf)
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                below, _ = bounds(_matrix(piece.column("cells"), np.uint8, dim))
                own = piece.column("id").to_numpy()
                below[ids[:, None] == own[None, :]] = -np.inf
                best = np.hstack([best, below])
                if best.shape[1] > k:
                    best = -np.partition(-best, k - 1, axis=1)[:, :k]
        where, _ = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(best[best > -np.inf])], ["query", "bound"])

    order = Window.partitionBy("query").orderBy(F.desc("bound"))
    kth = (
        index.select("id", "cells")
        .mapInArrow(lower_bounds, "query long, bound double")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") == k)
    )
    threshold = np.full(len(ids), -np.inf)
    for row in kth.collect():
        threshold[row["query"]] = row["bound"]

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _Bounds(vectors, low, width)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        certain = threshold.copy()
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(start, CHUNK)
                _, above = bounds(_matrix(piece.column("cells"), np.uint8, dim))
                own, exact = piece.column("id").to_numpy(), None
                above[ids[:, None] == own[None, :]] = -np.inf
                for q in np.flatnonzero((above >= certain[:, None]).any(axis=1)):
                    near = np.flatnonzero((above[q] >= certain[q]) & (above[q] > -np.inf))
                    near = near[np.argsort(-above[q][near], kind="stable")]
                    if exact is None:
                        exact = piece.column("exact")
                    step = 4 * k
                    for at in range(0, len(near), step):
                        take = near[at : at + step]
                        if above[q][take[0]] < certain[q]:
                            break
                        scores = _exact(vectors[q], _matrix(exact.take(pa.array(take)), np.int32, dim))
                        score = np.concatenate([best[q][0], scores])
                        name = np.concatenate([best[q][1], own[take]])
                        keep = np.lexsort((name, -score))[:k]
                        best[q] = (score[keep], name[keep])
                        if len(keep) == k:
                            certain[q] = max(certain[q], float(score[keep[-1]]))
        sizes = [len(b[0]) for b in best]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(names, sizes).tolist(), pa.string()),
                pa.array(np.repeat(ids, sizes)),
                pa.array(np.concatenate([b[1] for b in best]) if best else np.empty(0, np.int64)),
                pa.array(np.concatenate([b[0] for b in best]) if best else np.empty(0, np.int64)),
            ],
            ["query_row", "query_id", "vec_id", "score"],
        )

    return index.select("id", "cells", "exact").mapInArrow(
        refine, "query_row string, query_id long, vec_id long, score long"
    )
