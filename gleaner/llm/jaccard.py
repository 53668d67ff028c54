"""Join of documents by n-gram Jaccard similarity over size-banded tiles with bitmap signatures."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Bitmap, hash_strings, lean, mix64, saved, shingle_hashes, slices, small_side, words
from gleaner.llm.components import components

BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
SKETCH_BITS = 7  # at least 128 buckets, and one for every SKETCH_LOAD / 2 to SKETCH_LOAD shingles of larger sets
SKETCH_LOAD = 12
PACKED_KEYS = 1 << 19
BITS_PER_SHINGLE = 8
MOST_BITS = 1 << 17


@dataclass(frozen=True)
class Bands:
    """Lower ends of size bands; by tile (a band and the one below), the most differing shingles and the slack."""

    lower: list[int]
    apart: list[int]
    slack: list[int]


@dataclass(frozen=True)
class Similarity:
    """Link two sets of word n-grams if parts * intersection >= share * union."""

    n: int = 5
    share: int = 4
    parts: int = 5

    def bands(self, largest: int) -> Bands:
        """Size bands up to a largest set: sets that can link lie in one band or in neighbours."""
        out = [1]
        while len(out) < 4 or out[-4] <= largest:  # the last set's tiles reach into the bands behind its own
            out.append(max(out[-1] + 1, -(-out[-1] * self.parts // self.share)))
        apart = [self.apart(2 * (high - 1)) for high in out[1:]]
        return Bands(out, apart, [_slack(d, out[max(0, i - 1)]) for i, d in enumerate(apart)])

    def apart(self, total: int) -> int:
        """Most elements that are in one of two linked sets only, with ``total`` elements in both together."""
        return (self.parts - self.share) * total // (self.parts + self.share)

    def linked(self, common, total):
        return self.parts * common >= self.share * (total - common)


def _sets(piece: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, owners and sorted shingle hashes of a batch of texts."""
    row, code, vocabulary = words(piece.column("text"))
    hashed = hash_strings(vocabulary) if len(vocabulary) else np.zeros(0, np.uint64)
    owner, value = shingle_hashes(row, hashed[code], piece.num_rows, n)
    return np.bincount(owner, minlength=piece.num_rows), owner, value


def _set_hashes(counts: np.ndarray, value: np.ndarray) -> np.ndarray:
    """One hash for each set; the same for equal sets."""
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = mix64(np.add.reduceat(mix64(value), starts) + counts[some].astype(np.uint64))
    return out.view(np.int64)


def sketch(value: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each bucket of the hash range, at most 255; more buckets for larger sets."""
    bits = max(SKETCH_BITS, int(len(value) // SKETCH_LOAD).bit_length())
    bucket = (mix64(value + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(64 - bits)).astype(np.int64)
    return np.minimum(np.bincount(bucket, minlength=1 << bits), 255).astype(np.uint8)


def _describe(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            counts, _, value = _sets(piece, n)
            ends = np.cumsum(counts)
            node = pa.array(_set_hashes(counts, value), mask=counts == 0)
            drawn = pa.array([sketch(value[e - c : e]).tobytes() for c, e in zip(counts, ends)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("text_hash"), pa.array(counts), node, drawn],
                ["doc_id", "text_hash", "n_shingles", "node", "sketch"],
            )


def _slack(apart: int, least: int) -> int:
    """Slices beyond the differing ones: more than are empty, as good as always, in a set of ``least`` shingles."""
    slack = 2
    for _ in range(50):
        count = apart + 1 + slack
        empty = count * np.exp(-least / count)
        slack = max(slack, int(np.ceil(empty + 4 * np.sqrt(empty))))
    return min(slack, apart + 2)


def _tile_keys(node: int, value: np.ndarray, rule: Similarity, bands: Bands) -> np.ndarray:
    """Keys of the tiles of one set.

    A tile is a pair of neighbouring bands (or one band), a slice of the hash range and the shingles there.  The
    range has more slices than two linked sets of the tile's sizes can have differing shingles, so they agree on
    some slice; where a set has so many empty slices that these might be the only ones, the empty ones count too.
    """
    band = bisect_right(bands.lower, len(value)) - 1
    keys = []
    scrambled = mix64(value + np.uint64(0x5851F42D4C957F2D))
    top = value >> np.uint64(32)
    for tile in (band, band + 1):
        apart, slack = bands.apart[tile], bands.slack[tile]
        if not apart:
            continue
        count = apart + 1 + slack
        part = (top * np.uint64(count)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        content = np.add.reduceat(scrambled, starts)
        name = part[starts]
        if count - len(starts) > slack:
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), name)
            content, name = np.concatenate([content, np.zeros(len(empty), np.uint64)]), np.concatenate([name, empty])
        keys.append(mix64(mix64(content) + name + np.uint64(tile << 32)))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _slice_keys(piece: pa.RecordBatch, rule: Similarity, bands: Bands) -> Iterator[tuple[int, np.ndarray]]:
    """Node and tile keys of every different set of a batch."""
    counts, _, value = _sets(piece, rule.n)
    nodes = _set_hashes(counts, value)
    ends = np.cumsum(counts)
    _, once = np.unique(nodes, return_index=True)
    for i in once[counts[once] > 0]:
        yield nodes[i], _tile_keys(nodes[i], value[ends[i] - counts[i] : ends[i]], rule, bands)


def _packed_keys(
    batches: Iterator[pa.RecordBatch], rule: Similarity, bands: Bands, bits: int, bucket_bits: int
) -> Iterator[pa.RecordBatch]:
    """The upper ``bits`` of all tile keys, sorted, in blocks by their upper ``bucket_bits``: differences, byte by
    byte, compressed."""
    pack = zstandard.ZstdCompressor(level=1)

    def blocks(found: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(found)) >> np.uint64(64 - bits)
        bucket = (keys >> np.uint64(bits - bucket_bits)).astype(np.int64)
        cut = [0, *(np.flatnonzero(np.diff(bucket)) + 1), len(keys)]
        data = []
        for start, end in zip(cut, cut[1:]):
            step = np.diff(keys[start:end], prepend=np.uint64(0))
            data.append(pack.compress(step.view(np.uint8).reshape(-1, 8).T.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]]), pa.array(data, pa.binary())], ["bucket", "data"])

    found, held = [], 0
    for batch in batches:
        for piece in slices(batch, "text"):
            for _, keys in _slice_keys(piece, rule, bands):
                found.append(keys)
                held += len(keys)
            if held >= PACKED_KEYS:
                yield blocks(found)
                found, held = [], 0
    if held:
        yield blocks(found)


def _repeated_keys(table: pa.Table) -> pa.Table:
    """The keys of a bucket that occur more than once."""
    unpack = zstandard.ZstdDecompressor()
    parts = []
    for data in table.column("data").to_pylist():
        step = np.frombuffer(unpack.decompress(data), np.uint8).reshape(8, -1).T
        parts.append(np.cumsum(np.ascontiguousarray(step).view(np.uint64).ravel(), dtype=np.uint64))
    keys = np.sort(np.concatenate(parts))
    return pa.table({"key": pa.array(np.unique(keys[1:][keys[1:] == keys[:-1]]).view(np.int64))})


def _tiles(
    batches: Iterator[pa.RecordBatch], rule: Similarity, bands: Bands, bits: int, known: Bitmap
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            keys, names = [], []
            for node, found in _slice_keys(piece, rule, bands):
                found = found[known.hits((found >> np.uint64(64 - bits)).view(np.int64))]
                keys.append(found.view(np.int64))
                names.append(np.full(len(found), node))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(names))], ["key", "node"]
                )


def _contents(batches: Iterator[pa.RecordBatch], n: int, asked: Bitmap) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            counts, _, value = _sets(piece, n)
            nodes = _set_hashes(counts, value)
            ends = np.cumsum(counts)
            _, once = np.unique(nodes, return_index=True)
            take = once[(counts[once] > 0) & asked.hits(nodes[once])]
            own = [value[ends[i] - counts[i] : ends[i]] for i in take]
            shingles = pa.array([v.tobytes() for v in own], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(nodes[take]), shingles], ["node", "payload"])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of sets, one row each: every shingle sets the bit that its hash names.

    All have the same power of two of bits, which follows the largest set up to ``MOST_BITS``; with fewer bits
    the bound below is weaker, not wrong.
    """
    largest = max((len(x) for x in sets), default=0)
    bits = min(MOST_BITS, max(64, 1 << int(largest * BITS_PER_SHINGLE - 1).bit_length()))
    flags = np.zeros((len(sets), bits), np.uint8)
    for row, x in enumerate(sets):
        flags[row, (mix64(x) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, axis=1).view(np.uint64)


def may_link(one: np.ndarray, size: int, many: np.ndarray, sizes: np.ndarray, rule: Similarity) -> np.ndarray:
    """Which of many sets may link with one, by what the bit counts allow.

    Every bit that differs stands for a shingle that only one of the two sets has, which bounds their overlap.
    """
    apart = np.bitwise_count(many ^ one).sum(axis=1, dtype=np.int64)
    most = np.minimum((size + sizes - apart) // 2, np.minimum(size, sizes))
    return rule.linked(most, size + sizes)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def compare_sketches(table: pa.Table, rule: Similarity) -> pa.Table:
    """Pairs between two blocks (or inside one) whose bucket counts let them link, as few as join what all join.

    The buckets' differences add up to no more than the shingles that only one of the sets has.
    """
    node, size = table.column("node").to_numpy(), table.column("size").to_numpy()
    drawn = [np.frombuffer(x, np.uint8) for x in table.column("payload").to_pylist()]
    width = min(len(x) for x in drawn)
    counts = np.stack([x.reshape(width, -1).sum(axis=1, dtype=np.int32) for x in drawn])
    group = np.arange(len(node))
    found_a, found_b = [], []
    second = np.flatnonzero(table.column("right").to_numpy())
    for i in np.flatnonzero(table.column("left").to_numpy()):
        apart = np.abs(counts[second] - counts[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum((size[i] + size[second] - apart) // 2, np.minimum(size[i], size[second]))
        for j in second[rule.linked(most, size[i] + size[second]) & (node[second] != node[i])]:
            if group[i] != group[j]:
                group[group == group[j]] = group[i]
                found_a.append(node[i])
                found_b.append(node[j])
    return pa.table({"cluster": pa.array(found_a, pa.int64()), "node": pa.array(found_b, pa.int64())})


def compare_blocks(table: pa.Table, rule: Similarity) -> pa.Table:
    """Links between two blocks of sets (or inside one), as few as join what all of them join: cluster (a), node (b).

    Bit counts bound the overlap from above; sets in one component so far are not compared, the sorted arrays of
    the others are intersected.
    """
    node, label = table.column("node").to_numpy(), table.column("label").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("payload").to_pylist()]
    size, bits = np.array([len(x) for x in sets]), signatures(sets)
    group = np.unique(label, return_inverse=True)[1]
    found_a, found_b = [], []
    second = np.flatnonzero(table.column("right").to_numpy())
    for i in np.flatnonzero(table.column("left").to_numpy()):
        near = second[may_link(bits[i], size[i], bits[second], size[second], rule)]
        for j in near[node[near] != node[i]]:
            if group[i] != group[j] and rule.linked(_common(sets[i], sets[j]), size[i] + size[j]):
                group[group == group[j]] = group[i]
                found_a.append(node[i])
                found_b.append(node[j])
    return pa.table({"cluster": pa.array(found_a, pa.int64()), "node": pa.array(found_b, pa.int64())})


def _all_links(table: pa.Table, rule: Similarity, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all linked pairs between two blocks (or inside one), each pair once.

    The payloads' first ``skip`` bytes are not part of the sets.
    """
    node, left = table.column("node").to_numpy(), table.column("left").to_numpy()
    sets = [np.frombuffer(x, np.uint64, offset=skip) for x in table.column("payload").to_pylist()]
    size, bits = np.array([len(x) for x in sets]), signatures(sets)
    found_a, found_b = [], []
    second = np.flatnonzero(table.column("right").to_numpy())
    for i in np.flatnonzero(left):
        near = second[may_link(bits[i], size[i], bits[second], size[second], rule)]
        for j in near[~left[near] | (node[near] > node[i])]:  # inside a block every pair would come twice
            if rule.linked(_common(sets[i], sets[j]), size[i] + size[j]):
                found_a.append(i)
                found_b.append(j)
    return np.array(found_a, np.int64), np.array(found_b, np.int64)


def compare_all(table: pa.Table, rule: Similarity) -> pa.Table:
    """All linked pairs between two blocks of sets (or inside one): cluster (a), node (b)."""
    node = table.column("node").to_numpy()
    a, b = _all_links(table, rule)
    return pa.table({"cluster": pa.array(node[a], pa.int64()), "node": pa.array(node[b], pa.int64())})


def count_links(table: pa.Table, rule: Similarity) -> pa.Table:
    """Copies of the sets that each set of two blocks (or of one) links with: cluster (the set), node (their number).

    The payloads begin with the number of copies, eight bytes, the highest first.
    """
    node = table.column("node").to_numpy()
    copies = np.array([int.from_bytes(x[:8], "big") for x in table.column("payload").to_pylist()], np.int64)
    a, b = _all_links(table, rule, 8)
    total = np.zeros(len(node), np.int64)
    np.add.at(total, a, copies[b])
    np.add.at(total, b, copies[a])
    some = total > 0
    return pa.table({"cluster": pa.array(node[some], pa.int64()), "node": pa.array(total[some], pa.int64())})


def _in_blocks(
    members: DataFrame,
    payloads: DataFrame,
    weight: Column,
    rule: Similarity,
    compare: Callable[[pa.Table, Similarity], pa.Table],
) -> DataFrame:
    """Compare the members (cluster, node, label, size) of a cluster that are in different components.

    ``payloads`` (node, payload) are what is compared; they join the members last, when these are dealt to tasks.
    ``weight`` is the bytes of one.

    A cluster of bounded rows and bytes is one block.  A larger one is cut by size band and, for components that
    fill blocks of their own, by component; these are cut by hash into blocks of about those bounds.  Blocks of
    one band or of neighbours meet in pairs, but not those of one large component.
    """
    rows, total = F.count(F.lit(1)), F.sum(weight)
    of_cluster = members.groupBy("cluster").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), rows.alias("rows"), total.alias("bytes")
    )
    open_ = of_cluster.where("low != high").select("cluster", "rows", "bytes")
    of_label = members.groupBy("cluster", "label").agg(rows.alias("labelled"))
    ratio = float(np.log(rule.parts / rule.share))
    large = (F.col("rows") > BLOCK_ROWS) | (F.col("bytes") > BLOCK_BYTES)
    placed = saved(
        members.join(open_, "cluster")
        .join(of_label, ["cluster", "label"])
        .withColumn("band", F.when(large, F.floor(F.log("size") / F.lit(ratio))).otherwise(0).cast("int"))
        .withColumn("own", F.when(large & (F.col("labelled") > BLOCK_ROWS), F.col("label")))
        .select("cluster", "node", "label", "size", "band", "own")
    )
    needed = F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(total / BLOCK_BYTES))
    cut = placed.groupBy("cluster", "own", "band").agg(needed.alias("blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part")
    blocks = saved(cut.select("*", every).withColumn("block", F.monotonically_increasing_id()))
    one = blocks.select("cluster", F.col("own").alias("own_i"), F.col("band").alias("band_i"), F.col("block").alias("i"),
                        F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    two = blocks.select("cluster", F.col("own").alias("own_j"), "band", F.col("block").alias("j"))
    met = one.join(two, ["cluster", "band"]).where((F.col("band") != F.col("band_i")) | (F.col("i") <= F.col("j")))
    met = met.where(F.col("own_i").isNull() | F.col("own_j").isNull() | (F.col("own_i") != F.col("own_j")))
    met = saved(met.select("i", "j").withColumn("pair", F.monotonically_increasing_id()))
    same = F.col("i") == F.col("j")
    sides = met.select("pair", F.col("i").alias("block"), F.lit(True).alias("left"), same.alias("right")).unionByName(
        met.where(~same).select("pair", F.col("j").alias("block"), F.lit(False).alias("left"), F.lit(True).alias("right"))
    )
    place = ["cluster", "own", "band"]
    named = blocks.withColumnsRenamed({c: f"{c}_" for c in (*place, "part")})
    part = F.pmod(F.xxhash64("node"), F.col("blocks")) == F.col("part_")
    here = [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in place]
    at = placed.join(named, here[0] & here[1] & here[2]).where(part)
    columns = ["cluster", "node", "label", "size"]
    dealt = at.select("block", *columns).join(sides, "block").select("pair", "left", "right", *columns)
    return dealt.join(payloads, "node").groupBy("pair").applyInArrow(lambda t: compare(t, rule), "cluster long, node long")


def _groups(documents: DataFrame, described: DataFrame, rule: Similarity) -> tuple[DataFrame, DataFrame]:
    """Groups of sets that hold all links, as members of clusters, and the sets' contents: steps 1 and 2 of ``links``."""
    figures = described.agg(F.max("n_shingles").alias("largest"), F.sum("n_shingles").alias("total")).first()
    bands = rule.bands(figures["largest"] or 0)
    total = max(1, int(figures["total"] or 0))
    bits = min(62, total.bit_length() + 11)
    bucket_bits = (total // PACKED_KEYS).bit_length()
    packed = documents.mapInArrow(lean(lambda b: _packed_keys(b, rule, bands, bits, bucket_bits)), "bucket long, data binary")
    repeated = saved(packed.groupBy("bucket").applyInArrow(_repeated_keys, "key long"))
    known = Bitmap(repeated, "key")
    tiles = saved(documents.mapInArrow(lean(lambda b: _tiles(b, rule, bands, bits, known)), "key long, node long"))
    shared = tiles.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("tail")).where("head != tail")
    met = saved(tiles.join(shared, "key").select(F.col("head").alias("cluster"), "node").distinct())
    sketches = described.select("node", F.col("n_shingles").alias("size"), F.col("sketch").alias("payload"))
    sketches = saved(sketches.join(met.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]))
    sizes = sketches.select("node", "size")
    bounded = saved(met.join(sizes, "node").withColumn("label", F.col("node")))
    drawn = F.greatest(F.lit(1 << SKETCH_BITS), F.col("size") / (SKETCH_LOAD // 2))
    near = _in_blocks(bounded, sketches.select("node", "payload"), drawn, rule, compare_sketches)
    groups = saved(components(near.select(F.col("cluster").alias("a"), F.col("node").alias("b"))))

    asked = Bitmap(groups, "node")
    contents = documents.mapInArrow(lean(lambda b: _contents(b, rule.n, asked)), "node long, payload binary")
    contents = saved(contents.join(groups, "node", "left_semi").dropDuplicates(["node"]))
    members = groups.join(sizes, "node").select(F.col("label").alias("cluster"), "node", F.col("node").alias("label"), "size")
    return saved(members), contents


def links(documents: DataFrame, described: DataFrame, rule: Similarity) -> DataFrame:
    """Links a, b between set hashes that join the same sets as all links of the similarity do.

    1. The tile keys of all sets are sorted and packed in the tasks; keys that occur more than once are found by
       key range, and the sets are asked again for the tiles behind them.
    2. The sets that meet the least set of a tile (its head) in any tile are its cluster: sets that share a tile
       share a cluster. In the tasks, bucket counts bound which pairs of a cluster may link; out come only pairs
       that join two groups.
    3. The groups of sets that these pairs join are compared in the tasks, block by block, by bit counts and
       sorted arrays; again only links that join two groups come out.
    So no link between sets that are not joined otherwise is lost, and groups of near copies do not become rows
    of all their pairs.
    """
    members, contents = _groups(documents, described, rule)
    found = _in_blocks(members, contents, 8 * F.col("size"), rule, compare_blocks)
    return found.select(F.col("cluster").alias("a"), F.col("node").alias("b"))


def _described(df: DataFrame, rule: Similarity, id_column: str) -> tuple[DataFrame, DataFrame]:
    documents = df.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    hashed = documents.withColumn("text_hash", F.xxhash64("text"))
    described = saved(
        hashed.mapInArrow(
            lean(lambda b: _describe(b, rule.n)),
            "doc_id long, text_hash long, n_shingles long, node long, sketch binary",
        )
    )
    return documents, described


def _labelled(df: DataFrame, rule: Similarity, id_column: str) -> DataFrame:
    documents, described = _described(df, rule, id_column)
    nodes = described.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    labels = components(links(documents, described, rule))
    grouped = nodes.join(labels, "node", "left").select("node", "first_id", F.coalesce("label", "node").alias("label"))
    grouped = saved(grouped)
    name = grouped.groupBy("label").agg(F.min("first_id").alias("component"))
    of_node = grouped.join(name, "label").select("node", "component")
    alone = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return described.join(of_node, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", alone.alias("component_id")
    )


def near_duplicates(df: DataFrame, rule: Similarity = Similarity(), id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id.

    A row's set is that of its distinct word n-grams (words between ASCII white space, A-Z in lower case; with
    fewer words the whole sequence as one; without words or for a null text the empty set).  Rows with equal
    sets, and with sets that ``rule`` links, are in one component, named by the smallest id in it.  A row with
    the empty set is alone, under its own id.  A null id names no component unless all ids in it are null.

    Equal sets are one node from the start, so copies are never paired.  Sets and shingles are told apart by
    64-bit hashes.
    """
    return _labelled(df, rule, id_column).drop("text_hash")


def keep_first(df: DataFrame, rule: Similarity = Similarity(), id_column: str = "doc_id") -> DataFrame:
    """The rows of ``df`` without those of a component other than its smallest id.

    Rows with a null id stay, and so do rows that are repeated under the smallest id.
    """
    found = _labelled(df, rule, id_column).where("doc_id != component_id")
    gone = saved(found.select(F.col("doc_id").alias("gone_"), F.col("text_hash").alias("hash_")).distinct())
    same = (df[id_column].cast("long") == gone["gone_"]) & (F.xxhash64(df["text"]) == gone["hash_"])
    return df.join(small_side(gone), same, "left_anti")


def similar_pairs(df: DataFrame, rule: Similarity = Similarity(), id_column: str = "doc_id") -> DataFrame:
    """The join itself: all pairs of different sets that ``rule`` links, each once, as doc_a < doc_b.

    A set goes by the smallest id of its rows (null if they have none, then as doc_b), so copies do not multiply
    the pairs.
    """
    documents, described = _described(df, rule, id_column)
    members, contents = _groups(documents, described, rule)
    found = _in_blocks(members, contents, 8 * F.col("size"), rule, compare_all)
    names = saved(described.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first_id")))
    one = names.withColumnsRenamed({"node": "cluster", "first_id": "a"})
    named = found.join(one, "cluster").join(names, "node")
    a, b = F.col("a"), F.col("first_id")
    turned = a.isNull() | (b < a)
    return named.select(
        F.when(turned, b).otherwise(a).alias("doc_a"), F.when(turned, a).otherwise(b).alias("doc_b")
    )


def link_counts(df: DataFrame, rule: Similarity = Similarity(), id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, n_links.

    n_links is the number of other rows with an equal set or one that ``rule`` links; the empty set has none.
    Partners are counted in the tasks, weighted by their copies: no pair becomes a row.
    """
    documents, described = _described(df, rule, id_column)
    members, contents = _groups(documents, described, rule)
    copies = saved(described.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("copies")))
    head = F.unhex(F.lpad(F.hex("copies"), 16, "0"))
    weighted = contents.join(copies, "node").select("node", F.concat(head, "payload").alias("payload"))
    found = _in_blocks(members, saved(weighted), 8 * F.col("size"), rule, count_links)
    linked = found.groupBy(F.col("cluster").alias("node")).agg(F.sum("node").alias("linked"))
    of_node = copies.join(linked, "node", "left")
    of_node = of_node.select("node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    joined = described.join(of_node, "node", "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
