"""Exact nearest neighbours over vectors stored by cell: cells, and rows in them, are skipped by the triangle inequality."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from gleaner.operators.dense import TIE_DECIMALS, TOP_K, _arrow_schema, _Best, _vectors
from gleaner.operators.ranking import top_k_per_group
from gleaner.session import work_dir
from gleaner.sources.writers import saved, with_row_index, write_parquet

ROUNDS = 5
# Vectors that the first centres are drawn from, and the most cells: centres are held by every task.
MOST_CELLS = 4_096
QUERY_ROWS = 10_000
# Relative slack that covers the rounding of distances.
SLACK = 1e-7


@dataclass(frozen=True)
class CellIndex:
    """``rows`` (chunk_id, embedding, far, cell) in a folder a cell; ``far`` is the distance to the cell's centre.

    ``centres`` has a line a cell, ``nearest`` and ``radius`` the least and the greatest ``far``, ``size`` its rows.
    """

    rows: DataFrame
    centres: np.ndarray
    nearest: np.ndarray
    radius: np.ndarray
    size: np.ndarray


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :] - 2 * points @ centres.T
    return np.sqrt(np.maximum(square, 0))


def _first_centres(vectors: DataFrame, cells: int) -> np.ndarray:
    """``cells`` different vectors, those with the least hashes."""
    few = vectors.select("embedding").where("embedding is not null").distinct().orderBy(F.xxhash64("embedding")).limit(cells)
    table = few.toArrow()
    return _vectors(pa.nulls(table.num_rows), table.column(0))[1]


def _next_centres(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Means of the vectors nearest to each centre, added up in the tasks; a centre without vectors stays."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(centres), np.zeros(len(centres), np.int64)
        for batch in batches:
            _, rows = _vectors(batch.column(0), batch.column(1))
            if len(rows):
                cell = _distances(rows, centres).argmin(axis=1)
                np.add.at(total, cell, rows)
                count += np.bincount(cell, minlength=len(centres))
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.float64()))], ["cell", "n", "total"]
        )

    parts = vectors.select("chunk_id", "embedding").mapInArrow(part, "cell long, n long, total array<double>")

    def mean(table: pa.Table) -> pa.Table:
        total = np.array(table.column("total").to_pylist()).sum(axis=0) / table.column("n").to_numpy().sum()
        return pa.table({"cell": table.column("cell").slice(0, 1), "centre": [total.tolist()]})

    out = centres.copy()
    for row in parts.groupBy("cell").applyInArrow(mean, "cell long, centre array<double>").collect():  # a row a task each
        out[row["cell"]] = row["centre"]
    return out


def build_cells(vectors: DataFrame, path: str, cells: int, rounds: int = ROUNDS) -> CellIndex:
    """Store ``vectors (chunk_id, embedding)`` under ``path``, in folders by the nearest of ``cells`` k-means centres.

    A round is one scan with sums a task; the centres, of bounded number, go through the driver.  Rows without a
    vector are left out.  A cell with a large share of the rows is cut into several files.
    """
    stored = saved(vectors.select("chunk_id", "embedding").where("embedding is not null"))
    centres = _first_centres(stored, min(cells, MOST_CELLS))
    for _ in range(rounds if len(centres) else 0):
        centres = _next_centres(stored, centres)
    schema = StructType([*stored.schema.fields, StructField("far", DoubleType()), StructField("cell", IntegerType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, rows = _vectors(batch.column(0), batch.column(1))
            apart = _distances(rows, centres)
            cell = apart.argmin(axis=1)
            far = apart[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(far), pa.array(cell.astype(np.int32))], schema.fieldNames())

    placed = stored.mapInArrow(place, schema) if len(centres) else stored.select("*", F.lit(0.0).alias("far"), F.lit(0).alias("cell"))
    spread = placed.hint("rebalance", "cell").sortWithinPartitions("cell", "far")
    writer = spread.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy("cell") if len(centres) else writer).parquet(f"{path}/rows")
    spark = vectors.sparkSession
    held = spark.read.schema(schema).parquet(f"{path}/rows").groupBy("cell").agg(
        F.min("far").alias("nearest"), F.max("far").alias("radius"), F.count(F.lit(1)).alias("size")
    )
    lines = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, centre array<double>")
    write_parquet(lines.join(held, "cell").coalesce(1), f"{path}/centres")
    return open_cells(spark, path)


def open_cells(spark: SparkSession, path: str) -> CellIndex:
    lines = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()
    rows = spark.read.parquet(f"{path}/rows")
    numbers = [r["cell"] for r in lines]
    count = max(numbers, default=-1) + 1
    centres = np.full((count, len(lines[0]["centre"]) if lines else 0), np.inf)
    nearest, radius, size = np.zeros(count), np.zeros(count), np.zeros(count, np.int64)
    for r in lines:
        centres[r["cell"]], nearest[r["cell"]], radius[r["cell"]], size[r["cell"]] = r["centre"], r["nearest"], r["radius"], r["size"]
    return CellIndex(rows, centres, nearest, radius, size)


def _meetings(apart: np.ndarray, index: CellIndex, reach: np.ndarray) -> np.ndarray:
    """Which queries (rows) may have a neighbour within ``reach`` in which cells (columns)."""
    least = np.maximum(np.maximum(apart - index.radius, index.nearest - apart), 0)
    return (least <= reach[:, None] * (1 + SLACK) + SLACK) & (index.size > 0)


def _scan(
    index: CellIndex, queries: np.ndarray, apart: np.ndarray, meet: np.ndarray, reach: np.ndarray, k: int, schema: StructType
) -> DataFrame:
    """The k best rows of every task, for queries by their place; a query meets its cells only, and in them the rows
    whose distance to the centre allows it."""
    arrow = _arrow_schema(schema)
    cells = [int(c) for c in np.flatnonzero(meet.any(axis=0))]
    edge = reach * (1 + SLACK) + SLACK

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(queries, k, "l2")
        for batch in batches:
            ids, rows = _vectors(batch.column(0), batch.column(1))
            far, cell = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            for c in np.unique(cell):
                mine, asked = np.flatnonzero(cell == c), np.flatnonzero(meet[:, c])
                if not len(asked):
                    continue
                low, high = (apart[asked, c] - edge[asked]).min(), (apart[asked, c] + edge[asked]).max()
                mine = mine[(far[mine] >= low) & (far[mine] <= high)]
                best.offer(asked, ids[mine], rows[mine])
        yield from best.batches(np.arange(len(queries)), arrow)

    # folders of other cells are not opened
    return index.rows.where(F.col("cell").isin(cells)).select("chunk_id", "embedding", "far", "cell").mapInArrow(scan, schema)


def _order() -> list:
    return [F.round("distance", TIE_DECIMALS).asc(), F.asc("chunk_id")]


def knn_cells(queries: DataFrame, index: CellIndex, k: int = TOP_K, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Exact top-k by squared distance as ``(query_id, rank, chunk_id, distance)``, as the full scan gives it.

    Queries ``(query_id, embedding)`` are taken in blocks, one after the other; a block's hits are stored before the
    next.  Its nearest cells are read first; the kth distance found there, or what the cells' radii promise, is the
    reach.  Then the cells are read that come within reach.  Queries without a vector have no hits.
    """
    spark = queries.sparkSession
    hits = StructType(
        [queries.schema["query_id"], StructField("rank", LongType()), index.rows.schema["chunk_id"], StructField("distance", DoubleType())]
    )
    path = work_dir(spark)
    spark.createDataFrame([], hits).write.parquet(f"{path}/block=none")
    for first, ids, vectors in _blocks(queries, query_rows):
        found, _ = _search_block(index, vectors, k)
        names = spark.createDataFrame(list(enumerate(ids)), StructType([StructField("place", LongType()), hits["query_id"]]))
        named = found.join(F.broadcast(names), "place").select("query_id", F.col("rank").cast("long").alias("rank"), "chunk_id", "distance")
        named.write.parquet(f"{path}/block={first}")
    return spark.read.schema(hits).parquet(f"{path}/block=*").withColumn("rank", F.col("rank").cast("int"))


def cells_read(queries: DataFrame, index: CellIndex, k: int = TOP_K, query_rows: int = QUERY_ROWS) -> float:
    """Share of all (query, cell) meetings that a search looks into."""
    met = total = 0
    for _, _, vectors in _blocks(queries, query_rows):
        _, meet = _search_block(index, vectors, k)
        met, total = met + int(meet.sum()), total + meet.shape[0] * int((index.size > 0).sum())
    return met / total if total else 0.0


def _blocks(queries: DataFrame, query_rows: int) -> Iterator[tuple[int, list, np.ndarray]]:
    numbered = saved(with_row_index(queries.select("query_id", "embedding").where("embedding is not null"), ["query_id"], "at"))
    for first in range(0, numbered.count(), query_rows):
        part = numbered.where(F.col("at").between(first, first + query_rows - 1)).orderBy("at").select("query_id", "embedding")
        table = part.toArrow()
        yield first, table.column(0).to_pylist(), _vectors(table.column(0), table.column(1))[1]


def _search_block(index: CellIndex, vectors: np.ndarray, k: int) -> tuple[DataFrame, np.ndarray]:
    schema = StructType(
        [StructField("place", LongType()), index.rows.schema["chunk_id"], StructField("distance", DoubleType())]
    )
    if not len(index.size):
        return index.rows.sparkSession.createDataFrame([], StructType([*schema.fields, StructField("rank", LongType())])), np.zeros((len(vectors), 0), bool)
    apart = np.where(index.size > 0, _distances(vectors, np.where(np.isfinite(index.centres), index.centres, 0)), np.inf)
    # whole cells within a distance hold k rows
    most = apart + index.radius
    order = np.argsort(most, axis=1)
    held = np.cumsum(index.size[order], axis=1)
    enough = (held >= k).argmax(axis=1)
    promised = np.take_along_axis(most, np.take_along_axis(order, enough[:, None], 1), 1)[:, 0]
    reach = np.where(held[:, -1] >= k, promised, np.inf)
    first = np.zeros(apart.shape, bool)
    first[np.arange(len(vectors)), apart.argmin(axis=1)] = True
    near = top_k_per_group(_scan(index, vectors, apart, first, reach, k, schema), ["place"], _order(), k)
    for row in near.where(F.col("rank") == k).select("place", "distance").collect():
        reach[row["place"]] = min(reach[row["place"]], float(np.sqrt(row["distance"])))
    meet = _meetings(apart, index, reach)
    return top_k_per_group(_scan(index, vectors, apart, meet, reach, k, schema), ["place"], _order(), k), meet
