"""What several of these operators share: scratch tables, hold-out folds, hashes and words in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import work_dir

BATCH_BYTES = 2 << 20


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later steps neither recompute nor disagree."""
    path = work_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A stored table of narrow rows, to be broadcast if it has at most ``most`` rows, to be shuffled otherwise."""
    return F.broadcast(df) if df.count() <= most else df


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % folds


def finite_vector(x: Column) -> Column:
    """Whether an array of doubles holds neither nulls nor non-finite components; null for a null array."""
    return F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds much more than ``max_bytes`` of text; one long text is one slice."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)


Batches = Iterator[pa.RecordBatch]


def lean(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function`` for an Arrow map, giving the memory it is done with back to the system at the task's end.

    Python workers live on from stage to stage: what their allocators keep adds up, and is missing for the JVM.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
            if trim:
                trim(0)

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space, A-Z lower-cased: row of each word, its code, and the distinct words by code.

    A null text has no words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(text, "")))
    flat, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(flat), 0)
    coded = pc.filter(flat, real).dictionary_encode()
    return (
        pc.filter(rows, real).to_numpy().astype(np.int64),
        coded.indices.to_numpy().astype(np.int64),
        coded.dictionary,
    )


def shingle_hashes(rows: np.ndarray, hashes: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes per row, sorted by row and hash: the rows and the hashes.

    ``rows`` ascends; ``hashes`` belong to the words.  A row with fewer than ``size``
    words has its whole sequence as one shingle; one without words has none.
    """
    counts = np.bincount(rows, minlength=n)
    starts = np.concatenate([[0], np.cumsum(counts)])[:-1]
    width = np.minimum(counts, size)[rows]
    position = np.arange(len(rows)) - starts[rows]
    first = np.flatnonzero(position <= counts[rows] - width)
    first = first[(position[first] == 0) | (counts[rows[first]] >= size)]
    value = width[first].astype(np.uint64)
    for k in range(size):
        inside = width[first] > k
        step = np.where(inside, hashes[np.minimum(first + k, max(len(hashes) - 1, 0))], np.uint64(0))
        value = np.where(inside, mix64(value * np.uint64(0x9E3779B97F4A7C15) + step), value)
    owner = rows[first]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[fresh], value[fresh]



BITMAP_BITS = 1 << 26


class Bitmap:
    """A one-hash Bloom filter of fixed size over 64-bit keys: never misses a member, may pass others.

    8 MB whatever the data, so it can go to every task; a join after it decides exactly.  With far more members
    than bits it passes everything, and that join does all the work.
    """

    def __init__(self, df: DataFrame, column: str, bits: int = BITMAP_BITS):
        self.shift = 64 - (bits.bit_length() - 1)

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                place = self._place(batch.column(0).drop_null().to_numpy())
                word, start = np.unique(place >> 5, return_index=False, return_inverse=True)
                value = np.zeros(len(word), np.int64)
                np.bitwise_or.at(value, start, np.int64(1) << (place & 31))
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value)], ["w", "v"])

        parts = df.select(column).mapInArrow(lean(places), "w long, v long")
        rows = parts.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()  # at most bits / 32 rows
        data = np.zeros(bits // 32, np.uint32)
        data[rows.column("w").to_numpy()] = rows.column("v").to_numpy().astype(np.uint32)
        self.sent = df.sparkSession.sparkContext.broadcast(data)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.view(np.uint64)) >> np.uint64(self.shift)).astype(np.int64)

    def __contains__(self, key: int) -> bool:
        return bool(self.hits(np.array([key], np.int64))[0])

    def hits(self, keys: np.ndarray) -> np.ndarray:
        """Which keys may be members."""
        place = self._place(np.ascontiguousarray(keys))
        return (self.sent.value[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1) > 0
