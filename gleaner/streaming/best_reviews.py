"""Keep each product's best reviews in the state store, so that a drop reads no earlier one."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import StringType, StructField, StructType

from gleaner.operators.products import META_COLUMNS, REVIEW_SEPARATOR, documents_from_sources
from gleaner.sources.writers import write_parquet

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
GROUP = "_group"
PACKED = f"{GROUP} int, rows binary"
# Rows and bytes of a drop that a task holds at a time, about.
TASK_ROWS, TASK_BYTES = 1_000_000, 64 << 20
# Products of a group, about, and fewest groups.
GROUP_PRODUCTS, LEAST_GROUPS = 500, 16
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def best_reviews(
    reviews: DataFrame,
    key: str = "parent_asin",
    k: int = 10,
    text: str = "title",
    votes: str = "helpful_vote",
    ties: Sequence[str] = (),
    groups: int = LEAST_GROUPS,
) -> DataFrame:
    """From a stream of reviews, ``(key, combined_reviews)`` of the products whose best ``k`` changed.

    After each drop a product's row equals that of ``combine_reviews`` over all its
    reviews so far, in whatever order they came; give ``ties`` a unique tail where equal
    votes occur.  Ties are numbers, strings, dates or timestamps.  Rows without a key go
    first, null titles use up a rank, equal rows count each.  The state of a product is
    its k best rows.  Tasks cut what they read to k rows per product before the shuffle,
    so that a product with a large share of a drop arrives small.

    Products lie in ``groups`` by a hash of their key; a group's rows are one state, an Arrow table that is ranked
    column by column.  So the state is called once a group and not once a product.  ``groups`` must stay as they are
    as long as the state is kept.
    """
    tail = list(ties) or [text]
    others = list(dict.fromkeys([votes, *tail, text]))
    slim = reviews.where(F.col(key).isNotNull()).select(key, *others)
    out = StructType([slim.schema[key], StructField("combined_reviews", StringType())])
    group = F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias(GROUP)
    packed = slim.select(group, "*").mapInArrow(_cut_and_packed(key, votes, tail, k), PACKED)
    keeper = BestRows(key, text, votes, tail, k)
    return packed.groupBy(GROUP).transformWithState(keeper, "rows binary", "Update", "None").mapInArrow(_unpacked, out)


def _bytes(rows: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write(rows)
    return sink.getvalue().to_pybytes()


def _table(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _one_batch(rows: pa.Table) -> pa.RecordBatch:
    return rows.combine_chunks().to_batches()[0]


def _cut_and_packed(key: str, votes: str, tail: Sequence[str], k: int) -> Callable:
    """The best rows of what a task has read, every ``TASK_ROWS`` or ``TASK_BYTES`` or so, one packed row a group."""

    def cut(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = first_per_key(_one_batch(pa.Table.from_batches(held)), key, votes, tail, k)
        rows = rows.take(pc.sort_indices(rows.column(GROUP)))
        group = rows.column(GROUP).to_numpy()
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        rows = rows.drop_columns([GROUP])
        data = [_bytes(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(group)])]
        yield pa.RecordBatch.from_arrays([pa.array(group[starts], pa.int32()), pa.array(data, pa.binary())], [GROUP, "rows"])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, size = [], 0, 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count, size = count + batch.num_rows, size + batch.nbytes
            if count >= TASK_ROWS or size >= TASK_BYTES:
                yield from cut(held)
                held, count, size = [], 0, 0
        if held:
            yield from cut(held)

    return pack


def _unpacked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            yield from _table(packed).to_batches()


def first_per_key(batch: pa.RecordBatch, key: str, votes: str, tail: Sequence[str], k: int) -> pa.RecordBatch:
    """The rows of a batch that are among the first ``k`` of their key."""
    columns, order = {"key": batch.column(key)}, [("key", "ascending")]
    for place, name in enumerate([votes, *tail]):
        # Nulls and NaN are ranked by a column of their own: both come last or first as in Spark.
        values, falling = batch.column(name), place == 0
        odd = pa.array(np.ones(len(values), dtype=np.int8))
        if pa.types.is_floating(values.type):
            nan = pc.fill_null(pc.is_nan(values), False)
            odd = pc.if_else(nan, pa.scalar(0 if falling else 2, pa.int8()), odd)
            values = pc.if_else(nan, pa.scalar(0.0, values.type), values)
        odd = pc.if_else(pc.is_null(batch.column(name)), pa.scalar(2 if falling else 0, pa.int8()), odd)
        columns |= {f"odd{place}": odd, f"value{place}": values}
        order += [(f"odd{place}", "ascending"), (f"value{place}", "descending" if falling else "ascending")]
    sorted_rows = pc.sort_indices(pa.table(columns), sort_keys=order)
    keys = batch.column(key).take(sorted_rows)
    starts = np.ones(len(keys), dtype=bool)
    starts[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
    place = np.arange(len(keys))
    rank = place - np.maximum.accumulate(np.where(starts, place, 0))
    return batch.take(sorted_rows.filter(pa.array(rank < k)))


class BestRows(StatefulProcessor):
    """State of one group of products: the best rows of each, by product and best first."""

    def __init__(self, key: str, text: str, votes: str, tail: Sequence[str], k: int) -> None:
        self.key, self.text, self.votes, self.tail, self.k = key, text, votes, list(tail), k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "rows binary")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held = self.best.get() if self.best.exists() else None
        known = _table(bytes(held[0])) if held else None
        arrived = [_table(bytes(row["rows"])) for row in rows]
        every = _one_batch(pa.concat_tables(([] if known is None else [known]) + arrived))
        best = first_per_key(every, self.key, self.votes, self.tail, self.k)
        before = {} if known is None else self._titles(known)
        if known is not None and pa.Table.from_batches([best]).equals(known):
            return
        self.best.update((_bytes(best),))
        after = self._titles(best)
        changed = [name for name, titles in after.items() if before.get(name) != titles]
        if changed:
            shown = [[title for title in after[name] if title is not None] for name in changed]
            texts = pa.array([REVIEW_SEPARATOR.join(s) if s else None for s in shown], pa.string())
            names = pa.array(changed, best.schema.field(self.key).type)
            yield Row(rows=_bytes(pa.RecordBatch.from_arrays([names, texts], [self.key, "combined_reviews"])))

    def close(self) -> None:
        pass

    def _titles(self, rows: pa.RecordBatch | pa.Table) -> dict:
        """The titles of each product, best first."""
        found: dict = {}
        for name, title in zip(rows.column(self.key).to_pylist(), rows.column(self.text).to_pylist()):
            found.setdefault(name, []).append(title)
        return found


def latest_best(spark: SparkSession, root: str, key: str = "parent_asin") -> DataFrame:
    """``(key, combined_reviews)`` as of the last drop: one partial aggregation over the versions."""
    versions = spark.read.parquet(f"{root}/best")
    newest = F.max(F.struct("drop", "combined_reviews"))
    return versions.groupBy(key).agg(newest.alias("newest")).select(key, "newest.combined_reviews")


def _groups(spark: SparkSession, meta: DataFrame, root: str) -> int:
    """Groups of products that the state under ``root`` has, chosen at its first run by the rows of ``meta``."""
    try:
        chosen = spark.read.schema("groups int").parquet(f"{root}/groups").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        chosen = None
    if chosen:  # a run that died while it wrote left none, and no state
        return chosen["groups"]
    groups = max(LEAST_GROUPS, -(-meta.count() // GROUP_PRODUCTS))
    write_parquet(spark.createDataFrame([(groups,)], "groups int").coalesce(1), f"{root}/groups")
    return groups


def follow_best_reviews(
    spark: SparkSession,
    reviews: DataFrame,
    meta: DataFrame,
    root: str,
    key: str = "parent_asin",
    k: int = 10,
    columns: Sequence[str] = tuple(META_COLUMNS),
    order: Sequence[str] = (),
    text: str = "title",
    votes: str = "helpful_vote",
    ties: Sequence[str] = (),
    repeated: bool = False,
) -> StreamingQuery:
    """Process what arrived in the stream ``reviews`` since the last run, then stop.

    A drop writes the changed products' reviews to ``best`` and their documents to
    ``documents``, both under its number; ``latest_documents`` reads the latter.  State
    and drops are committed together: a drop repeated after a failure starts from the state
    before it and overwrites its own folders.  The number of state partitions is the session's
    ``spark.sql.shuffle.partitions`` at the first run.
    """

    def apply(batch: DataFrame, number: int) -> None:
        # Stored before any other use, as each evaluation of the batch would run through the state again.
        folder = f"{root}/best/drop={number}"
        write_parquet(batch, folder)
        changed = batch.sparkSession.read.schema(batch.schema).parquet(folder)
        touched = meta.join(changed.select(key), key, "left_semi")
        write_parquet(documents_from_sources(touched, changed, columns, key, order, repeated), f"{root}/documents/drop={number}")

    best = best_reviews(reviews, key, k, text, votes, ties, _groups(spark, meta, root))
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)  # the query takes a copy of the settings when it starts
    try:
        return (
            best.writeStream.foreachBatch(apply)
            .outputMode("update")
            .option("checkpointLocation", f"{root}/progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)
