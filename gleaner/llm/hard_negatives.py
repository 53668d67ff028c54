"""Hard negatives by a secondary sort: pair scores in the key, one streaming pass per anchor."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import finite_vector, saved
from gleaner.operators.ranking import top_k_per_group
from gleaner.session import work_dir
from gleaner.sources.writers import with_row_index

ANCHOR_BYTES = 8 << 20
STRIP = 64
CHUNK = 2048
FLOAT_EXACT, LONG = 1 << 53, 1 << 63
PARTITIONS = 64
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
# anchor's number in its block, falling score, 0 positive or 1 negative, id
KEY = ">QQBQ"
HALF = 1 << 63


@dataclass(frozen=True)
class Window:
    """Which rows are negatives of a positive: ``low * p <= of * score <= high * p`` for its score p."""

    low: int = 30
    high: int = 90
    of: int = 100

    def bounds(self, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score inside, both included; for Python integers."""
        return -((-self.low * positive) // self.of), (self.high * positive) // self.of


def integer_rows(df: DataFrame, id_column: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """``id``, ``label`` and ``v``, the floor of scale times each component as a double.

    Rows take no part whose id, label or vector is null or whose vector holds a null or a non-finite component.
    """
    x = F.col(vector).cast("array<double>")
    scaled = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    rows = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.when(finite_vector(x), scaled).alias("v"),
    )
    return rows.dropna(subset=["id", "label", "v"])


def products(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point or 64 bits only where that is exact."""
    width = max(anchors.shape[1], 1)
    top = int(np.abs(anchors).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * width
    if top < FLOAT_EXACT:
        return (anchors.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if top < LONG:
        return anchors @ vectors.T
    exact = anchors.astype(object) @ vectors.T.astype(object)
    if exact.size and max(abs(exact.min()), abs(exact.max())) >= LONG:
        raise ValueError("an inner product leaves 64 bits")
    return exact.astype(np.int64)


class Best:
    """For each of ``n`` lists the k greatest scores seen so far; ties go to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.size = np.zeros(n, np.int64)

    def add(self, lists: np.ndarray, score: np.ndarray, wanted: np.ndarray, ids: np.ndarray) -> None:
        """Offer row r of ``score`` to the list ``lists[r]``, where ``wanted``; ``ids`` name the columns."""
        full = self.size[lists] == self.k
        least = self.score[lists, self.k - 1]
        wanted = wanted & (~full[:, None] | (score >= least[:, None]))
        count = wanted.sum(axis=1)
        crowded = np.flatnonzero(count > 4 * self.k)
        if len(crowded):
            # what lies under the kth of this piece cannot enter
            some = np.where(wanted[crowded], score[crowded], np.iinfo(np.int64).min)
            kth = np.partition(some, some.shape[1] - self.k, axis=1)[:, some.shape[1] - self.k]
            wanted[crowded] &= score[crowded] >= kth[:, None]
            count = wanted.sum(axis=1)
        row, column = np.nonzero(wanted)
        touched = np.flatnonzero(count)
        if not len(touched):
            return
        held_row, held_place = np.nonzero(np.arange(self.k) < self.size[lists[touched], None])
        held_list = lists[touched][held_row]
        owner = np.concatenate([lists[row], held_list])
        points = np.concatenate([score[row, column], self.score[held_list, held_place]])
        names = np.concatenate([ids[column], self.id[held_list, held_place]])
        order = np.lexsort((names, ~points, owner))
        owner, points, names = owner[order], points[order], names[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = place < self.k
        owner, place = owner[keep], place[keep]
        self.score[owner, place], self.id[owner, place] = points[keep], names[keep]
        self.size[lists[touched]] = np.bincount(owner, minlength=len(self.size))[lists[touched]]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        owner, place = np.nonzero(np.arange(self.k) < self.size[:, None])
        return owner, self.score[owner, place], self.id[owner, place]


@dataclass(frozen=True)
class Block:
    """Anchors of one vector length that are compared together."""

    id: np.ndarray
    label: np.ndarray
    v: np.ndarray


def _pieces(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of the rows of length ``dim``, a bounded number at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            piece = batch.slice(start, CHUNK)
            piece = piece.filter(pc.equal(pc.list_value_length(piece.column("v")), dim))
            if piece.num_rows:
                flat = pc.list_flatten(piece.column("v")).to_numpy(zero_copy_only=False).astype(np.int64)
                yield (
                    piece.column("id").to_numpy(),
                    piece.column("label").to_numpy(),
                    flat.reshape(piece.num_rows, dim),
                )


def positives(rows: DataFrame, block: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k other rows with an anchor's label: anchor's place in the block, score and id, at most k an anchor."""
    dim, n = block.v.shape[1], len(block.id)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n, k)
        for ids, labels, vectors in _pieces(batches, dim):
            for start in range(0, n, STRIP):
                at = np.arange(start, min(start + STRIP, n))
                same = (block.label[at][:, None] == labels) & (block.id[at][:, None] != ids)
                best.add(at, products(block.v[at], vectors), same, ids)
        owner, score, name = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(score), pa.array(name)], ["place", "score", "id"])

    found = rows.mapInArrow(scan, "place long, score long, id long")
    best = top_k_per_group(found, ["place"], [F.desc("score"), F.asc("id")], k).toArrow()
    place, score, name = (best.column(c).to_numpy() for c in ("place", "score", "id"))
    order = np.lexsort((name, ~score, place))
    return place[order], score[order], name[order]


def pair_keys(
    rows: DataFrame, block: Block, found: tuple[np.ndarray, np.ndarray, np.ndarray], k: int, window: Window
) -> DataFrame:
    """Packed keys of the pairs that can be in the result: every positive, and for each the first k negatives of a task."""
    dim = block.v.shape[1]
    place, score, _ = found
    low, high = (b.astype(np.int64) for b in window.bounds(score.astype(object)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(place), k)
        for ids, labels, vectors in _pieces(batches, dim):
            for start in range(0, len(place), STRIP):
                at = np.arange(start, min(start + STRIP, len(place)))
                anchors, back = np.unique(place[at], return_inverse=True)
                scored = products(block.v[anchors], vectors)[back]
                other = (block.label[place[at]][:, None] != labels) & (block.id[place[at]][:, None] != ids)
                inside = (scored >= low[at][:, None]) & (scored <= high[at][:, None])
                best.add(at, scored, other & inside, ids)
        owner, points, names = best.rows()
        # a row in several windows of its anchor is sent once for each time it occurs in one of them
        once = _largest_count(place[owner], points, names, owner)
        keys = [pack(int(p), int(s), 1, int(i)) for p, s, i in zip(*once)]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["key"])

    spark = rows.sparkSession
    own = [(pack(int(p), int(s), 0, int(i)),) for p, s, i in zip(*found)]
    return rows.mapInArrow(scan, "key binary").unionByName(spark.createDataFrame(own, "key binary"))


def _largest_count(place: np.ndarray, points: np.ndarray, names: np.ndarray, owner: np.ndarray) -> list[np.ndarray]:
    """Rows by anchor, score and id, each as often as it occurs in the window that holds it most often."""
    order = np.lexsort((owner, names, points, place))
    columns = [c[order] for c in (place, points, names, owner)]
    if not len(order):
        return columns[:3]
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    first = np.flatnonzero(fresh)
    nth = np.arange(len(order)) - first[np.cumsum(fresh) - 1]
    again = np.lexsort((nth, columns[2], columns[1], columns[0]))
    columns = [c[again] for c in columns[:3]] + [nth[again]]
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return [c[fresh] for c in columns[:3]]


def pack(place: int, score: int, kind: int, name: int) -> bytes:
    """A key that sorts by anchor, then falling score, then positives first, then id.

    A positive stands before negatives of its own score, so that its window is open when they come.
    """
    return struct.pack(KEY, place, HALF - 1 - score, kind, name + HALF)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    place, down, kind, name = struct.unpack(KEY, key)
    return place, HALF - 1 - down, kind, name - HALF


def stream_negatives(
    keys: Iterator[bytes], window: Window, per_anchor: int, per_positive: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(place, positive, rank, negative, positive score, negative score)`` from keys in order.

    An anchor's positives open windows as they pass; a negative is ranked at once in every open window it fits.
    What is held is one counter a window.
    """
    current, open_windows, opened = None, [], 0
    for key in keys:
        place, score, kind, name = unpack(key)
        if place != current:
            current, open_windows, opened = place, [], 0
        if kind == 0:
            if opened < per_anchor:
                opened += 1
                open_windows.append([score, name, 0])
            continue
        for entry in open_windows:
            positive, owner, given = entry
            if given < per_positive and window.low * positive <= window.of * score <= window.high * positive:
                entry[2] = given + 1
                yield place, owner, given + 1, name, positive, score
        # scores only fall: a full window, or one whose lower end has passed, is done
        open_windows = [e for e in open_windows if e[2] < per_positive and window.low * e[0] <= window.of * score]


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    per_anchor: int = 5,
    per_positive: int = 10,
    window: Window = Window(),
    anchor_bytes: int = ANCHOR_BYTES,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Hard negatives of each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` have id, label and v (integers), as :func:`integer_rows` makes them.  The score of a row is
    its inner product with the anchor; higher scores come first, ties by smaller id.  An anchor's positives are its
    first ``per_anchor`` rows of the same label and another id; a positive's negatives are the first ``per_positive``
    rows of another label inside its window.  Fewer than that: all are returned.

    Rows with the anchor's id are no candidates.  Rows that repeat an id are candidates, positives and anchors one by one.
    An anchor meets only vectors of its own length.  No anchors or no rows: no result rows.  Scores beyond 64 bits are
    an error.

    Anchors are taken in blocks of bounded bytes, one after the other, against all rows.  A first scan keeps k positives
    an anchor in each task.  With them a second one packs only pairs that can still count into keys (anchor, falling
    score, kind, id), at most ``per_positive`` a window and task, so no anchor's group grows with the table.  The keys
    are shuffled by anchor and sorted on the way (repartitionAndSortWithinPartitions); one streaming pass
    opens the windows and ranks the negatives.  The result of each block is stored before the next.
    """
    spark = rows.sparkSession
    stored = saved(rows.select("id", "label", "v"))
    numbered = saved(
        with_row_index(anchors.select("id", "label", "v", F.size("v").alias("dim")), ["dim", "id", "label"], "at")
    )
    path = work_dir(spark)
    spark.createDataFrame([], RESULT).write.parquet(f"{path}/block=none")
    runs = numbered.groupBy("dim").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    for run in runs:
        step = max(1, anchor_bytes // (8 * max(run["dim"], 1)))
        for first in range(run["first"], run["first"] + run["n"], step):
            last = min(first + step, run["first"] + run["n"]) - 1
            table = numbered.where(F.col("at").between(first, last)).orderBy("at").select("id", "label", "v").toArrow()
            flat = pc.list_flatten(table.column("v")).to_numpy().astype(np.int64)
            block = Block(
                table.column("id").to_numpy(), table.column("label").to_numpy(), flat.reshape(table.num_rows, run["dim"])
            )
            _mine_block(stored, block, per_anchor, per_positive, window, partitions).write.parquet(f"{path}/block={first}")
    return spark.read.schema(RESULT).parquet(f"{path}/block=*")


def _mine_block(
    stored: DataFrame, block: Block, per_anchor: int, per_positive: int, window: Window, partitions: int
) -> DataFrame:
    found = positives(stored, block, per_anchor)
    keys = pair_keys(stored, block, found, per_positive, window)
    sorted_keys = keys.rdd.map(lambda row: (bytes(row[0]), None)).repartitionAndSortWithinPartitions(
        numPartitions=min(partitions, len(block.id)), partitionFunc=lambda key: struct.unpack(KEY, key)[0]
    )
    names = block.id

    def emit(part: Iterator[tuple[bytes, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
        for place, *rest in stream_negatives((key for key, _ in part), window, per_anchor, per_positive):
            yield (int(names[place]), *rest)

    return sorted_keys.mapPartitions(emit).toDF(RESULT)
