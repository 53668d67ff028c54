"""An index kept in segments: a drop adds one, replaced chunks are marked dead, small segments are merged.

Folders under the root: ``chunks``, ``vectors`` and ``terms`` by segment, ``dead`` by the commit that marked them,
``blocks`` as a table by segment, bucketed by shard, and ``versions`` with one row a commit.  A commit is listed last:
what a failed one left behind is never read.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions.text import Tokeniser, tokenise
from gleaner.operators.block_max import BlockIndex, cut_bags, cut_blocks, live_postings
from gleaner.operators.lexical import build_bags
from gleaner.sources.writers import saved, write_parquet

# Shards of an index: by the postings of its first drop, this many at least.
SHARDS = 16
SHARD_POSTINGS = 1_000_000
# More dead chunks than this, and than a part of the live ones, are not carried along: segments are merged, which costs
# as much as the whole index.  The greatest number bounds their list, which every task holds.
MOST_DEAD = 200_000
DEAD_PART = 4
GREATEST_DEAD = 2_000_000

VERSION = (
    "version long, segments array<string>, dead array<string>, n long, tokens long, avg_idf double, shards int, dead_rows long"
)


@dataclass(frozen=True)
class Segments:
    """One version of a segmented index."""

    spark: SparkSession
    root: str
    version: int
    segments: tuple[str, ...]
    dead_lists: tuple[str, ...]
    n: int
    tokens: int
    avg_idf: float
    shards: int
    dead_rows: int

    def _read(self, name: str, segments: Sequence[str] | None = None) -> DataFrame:
        chosen = self.segments if segments is None else segments
        base = f"{self.root}/{name}"
        return self.spark.read.option("basePath", base).parquet(*[f"{base}/segment={s}" for s in chosen])

    def dead(self) -> DataFrame | None:
        """``(segment, chunk_id)`` of replaced chunks, at most ``GREATEST_DEAD`` rows; None if there are none."""
        if not self.dead_rows:
            return None
        return self.spark.read.parquet(*[f"{self.root}/dead/list={d}" for d in self.dead_lists]).select("segment", "chunk_id")

    def _live(self, rows: DataFrame) -> DataFrame:
        dead = self.dead()
        return rows if dead is None else rows.join(F.broadcast(dead), ["segment", "chunk_id"], "left_anti")

    def chunks(self) -> DataFrame:
        """The live chunks, with the segment they lie in."""
        return self._live(self._read("chunks"))

    def vectors(self) -> DataFrame:
        """``(chunk_id, embedding)`` of the live chunks."""
        return self._live(self._read("vectors")).drop("segment")

    def terms(self) -> DataFrame:
        """``(term, df, ctf)`` of the live chunks: what segments added and took away, summed up."""
        parts = self._read("terms").groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))
        return parts.where("df > 0")

    def block_index(self) -> BlockIndex:
        blocks = self.spark.table(_blocks_table(self.spark, self.root, self.shards, self._key_type()))
        return BlockIndex(
            blocks.where(F.col("segment").isin(list(self.segments))),
            self.terms().select("term", "df"),
            self.n,
            self.tokens / max(self.n, 1),
            self.avg_idf,
            self.dead(),
        )

    def _key_type(self) -> str:
        return self._read("chunks").schema["chunk_id"].dataType.simpleString()


def _blocks_table(spark: SparkSession, root: str, shards: int, key_type: str, stored: bool = True) -> str:
    """Name of the table over ``blocks``, entered in this session's catalogue if it is not there.

    ``stored``: the folder holds committed segments, which the catalogue has to learn.
    """
    name = f"blocks_{uuid.uuid5(uuid.NAMESPACE_URL, root).hex}"
    path = f"{root}/blocks".replace("'", "\\'")
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"""CREATE TABLE {name} (shard INT, term STRING, block INT, size INT, max_tf INT, min_dl INT, tokens BIGINT,
                postings ARRAY<STRUCT<chunk_id: {key_type}, tf: INT, dl: INT>>, segment STRING)
                USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (segment)
                CLUSTERED BY (shard) SORTED BY (term) INTO {shards} BUCKETS LOCATION '{path}'"""
        )
        if stored:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def open_segments(spark: SparkSession, root: str) -> Segments | None:
    """The newest version under ``root``, or None."""
    root = root.rstrip("/")
    try:
        versions = spark.read.schema(VERSION).parquet(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = versions.orderBy(F.desc("version")).first()
    if row is None:
        return None
    return Segments(
        spark, root, row["version"], tuple(row["segments"]), tuple(row["dead"]), row["n"], row["tokens"], row["avg_idf"],
        row["shards"], row["dead_rows"],
    )


def _commit(index: Segments) -> Segments:
    """Publish: the mean inverse frequency is taken over the merged vocabulary, the rest is known."""
    plain = F.log(F.lit(index.n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    row = index.terms().agg(F.avg(plain).alias("avg_idf")).first()
    index = replace(index, avg_idf=row["avg_idf"] or 0.0)
    listed = [
        (index.version, list(index.segments), list(index.dead_lists), index.n, index.tokens, index.avg_idf, index.shards, index.dead_rows)
    ]
    index.spark.createDataFrame(listed, VERSION).coalesce(1).write.mode("append").parquet(f"{index.root}/versions")
    return index


def _tokens(bags: DataFrame) -> int:
    """The words of the chunks; an id that repeats counts once."""
    lengths = bags.where("dl > 0").groupBy("chunk_id").agg(F.max("dl").alias("dl"))
    return lengths.agg(F.sum("dl").alias("tokens")).first()["tokens"] or 0


def _write_blocks(blocks: DataFrame, root: str, segment: str, shards: int, key_type: str, stored: bool = True) -> None:
    name = _blocks_table(blocks.sparkSession, root, shards, key_type, stored)
    columns = ["shard", "term", "block", "size", "max_tf", "min_dl", "tokens", "postings"]
    placed = blocks.select(*columns, F.lit(segment).alias("segment"))  # cut by shard: a task writes one bucket
    writer = placed.write.mode("append").format("parquet").option("path", f"{root}/blocks")
    writer.option("compression", "zstd").partitionBy("segment").bucketBy(shards, "shard").sortBy("term").saveAsTable(name)


def add_segment(
    spark: SparkSession,
    root: str,
    chunks: DataFrame,
    touched: DataFrame | None = None,
    key: str = "parent_asin",
    embed_chunks: Callable[[DataFrame], DataFrame] | None = None,
    tokeniser: Tokeniser = tokenise,
    shards: int | None = None,
    most_dead: int = MOST_DEAD,
) -> Segments:
    """Commit a drop: ``chunks (chunk_id, key, text, ...)`` replace all live chunks of the keys in ``touched`` and of their own.

    Written are the new chunks' own tables, and for the replaced ones a list of their ids and what their words take
    away from the statistics; no earlier segment is touched.  ``embed_chunks`` adds the vectors, as
    ``(chunk_id, embedding)``.  A key in ``touched`` without chunks is deleted.  Chunks and touched keys are read more
    than once; null keys are kept and never replaced.  ``shards`` of the first drop hold for all; by default they are as
    many as its postings need, as a shard's postings are sorted and scored in one task.
    """
    root = root.rstrip("/")
    before = open_segments(spark, root)
    segment = uuid.uuid4().hex
    here = f"segment={segment}"
    write_parquet(chunks, f"{root}/chunks/{here}")
    added = spark.read.parquet(f"{root}/chunks/{here}")
    bags = saved(build_bags(added, tokeniser))
    size = bags.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("postings")).first()
    n, tokens = size["n"], _tokens(bags)
    shards = before.shards if before else shards or max(SHARDS, -(-(size["postings"] or 0) // SHARD_POSTINGS))
    key_type = added.schema["chunk_id"].dataType.simpleString()
    _write_blocks(cut_bags(bags, shards, tokens / max(n, 1)), root, segment, shards, key_type, before is not None)
    blocks = spark.table(_blocks_table(spark, root, shards, key_type)).where(F.col("segment") == segment)
    counts = blocks.select("term", F.col("size").cast("long").alias("df"), F.col("tokens").alias("ctf"))
    dead_lists, dead_rows = (list(before.dead_lists), before.dead_rows) if before else ([], 0)
    if before:
        keys = added.select(key).union(touched.select(key)) if touched is not None else added.select(key)
        keys = saved(keys.where(F.col(key).isNotNull()).distinct())
        gone = saved(before.chunks().join(keys, key, "left_semi").select("segment", "chunk_id", "text"))
        write_parquet(gone.select("segment", "chunk_id"), f"{root}/dead/list={segment}")
        lost = saved(build_bags(gone, tokeniser))
        fewer = gone.count()
        n, tokens = before.n + n - fewer, before.tokens + tokens - _tokens(lost)
        away = lost.select(F.inline(F.arrays_zip("terms", "tfs"))).select(
            F.col("terms").alias("term"), F.lit(-1).cast("long").alias("df"), (-F.col("tfs")).cast("long").alias("ctf")
        )
        counts = counts.unionByName(away)
        if fewer:
            dead_lists, dead_rows = [*dead_lists, segment], dead_rows + fewer
    terms = counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))
    write_parquet(terms, f"{root}/terms/{here}")
    if embed_chunks is not None:
        write_parquet(embed_chunks(added).select("chunk_id", "embedding"), f"{root}/vectors/{here}")
    earlier = before.segments if before else ()
    version = before.version + 1 if before else 1
    index = Segments(spark, root, version, (*earlier, segment), tuple(dead_lists), n, tokens, 0.0, shards, dead_rows)
    index = _commit(index)
    most_dead = max(most_dead, min(index.n // DEAD_PART, GREATEST_DEAD))
    return compact(index, None, tokeniser) if index.dead_rows > most_dead else index


def compact(index: Segments, segments: Sequence[str] | None = None, tokeniser: Tokeniser = tokenise) -> Segments:
    """Merge the named segments (all, by default) into one without dead chunks; the others stay as they are.

    Postings are taken over from the blocks, texts are not read again.
    """
    merged = list(index.segments if segments is None else segments)
    kept = [s for s in index.segments if s not in merged]
    segment = uuid.uuid4().hex
    here = f"segment={segment}"
    write_parquet(index._live(index._read("chunks", merged)).drop("segment"), f"{index.root}/chunks/{here}")
    blocks = index.block_index().blocks.where(F.col("segment").isin(merged))
    postings = live_postings(blocks, index.dead(), "term")
    _write_blocks(
        cut_blocks(postings, index.shards, index.tokens / max(index.n, 1)), index.root, segment, index.shards, index._key_type()
    )
    terms = index._read("terms", merged).groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))
    write_parquet(terms.where("df != 0 or ctf != 0"), f"{index.root}/terms/{here}")
    if _has_vectors(index, merged):
        write_parquet(index._live(index._read("vectors", merged)).drop("segment"), f"{index.root}/vectors/{here}")
    dead_lists, dead_rows, dead = [], 0, index.dead()
    if dead is not None:
        left = saved(dead.where(F.col("segment").isin(kept)))
        dead_rows = left.count()
        if dead_rows:
            write_parquet(left, f"{index.root}/dead/list={segment}")
            dead_lists = [segment]
    return _commit(
        replace(
            index, version=index.version + 1, segments=(*kept, segment), dead_lists=tuple(dead_lists), dead_rows=dead_rows
        )
    )


def _has_vectors(index: Segments, segments: Sequence[str]) -> bool:
    try:
        index._read("vectors", segments)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
