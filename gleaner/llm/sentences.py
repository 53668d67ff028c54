"""Substring deduplication by sliding spans of consecutive sentences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import Bitmap, lean, mix64, powers, saved, slices

SPAN_WORDS = 20
LAST = (1 << 63) - 1

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd


class Sentences:
    """Sentences of a batch of texts, and their spans.

    A sentence ends after a run of full stops, exclamation marks, question marks and newlines, or with the text.
    ``start`` and ``end`` are byte offsets in ``data``; ``owner`` is the text's number; ``words`` counts words.
    """

    def __init__(self, texts: list[str | None]):
        parts = [(t or "").encode() for t in texts]
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        size = np.array([len(p) for p in parts], np.int64)
        self.text_start = np.cumsum(size) - size
        n = len(self.data)
        ends = _END[self.data]
        last = np.zeros(n, bool)
        last[(self.text_start + size - 1)[size > 0]] = True
        follows = np.zeros(n, bool)
        follows[:-1] = ends[1:]
        self.end = np.flatnonzero((ends & ~follows) | last) + 1
        self.start = np.concatenate([[0], self.end[:-1]]).astype(np.int64)[: len(self.end)]
        self.owner = np.searchsorted(self.text_start, self.start, side="right") - 1
        # texts without bytes share their start with the next one, which owns the sentence
        space = _SPACE[self.data]
        opens = ~space
        opens[1:] &= space[:-1]
        opens[self.start] = ~space[self.start]
        if n:
            self.words = np.add.reduceat(opens, self.start, dtype=np.int64)
        else:
            self.words = np.zeros(0, np.int64)
        self._space, self._opens = space, opens

    def _hashes(self, base: int) -> np.ndarray:
        """Per sentence, a hash of its bytes in lower case (A-Z) without white space, word starts marked."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        solid = np.cumsum(~self._space)
        before = solid[self.start] - ~self._space[self.start]
        place = solid - 1 - np.repeat(before, self.end - self.start)
        value = _LOWER[self.data] + np.uint64(1) + (self._opens.astype(np.uint64) << np.uint64(9))
        value *= powers(base, int(place.max(initial=0)) + 1)[np.maximum(place, 0)]
        value[self._space] = 0
        return mix64(np.add.reduceat(value, self.start))

    def spans(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last sentence of each span, and two hashes of its content; a span once.

        Spans are, for every sentence with words, the shortest run that starts with it and the shortest that ends
        with it of at least ``least`` words, inside one text.
        """
        n = len(self.start)
        if not n:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),) * 2
        done = np.concatenate([[0], np.cumsum(self.words)])
        index = np.arange(n)
        onward = np.searchsorted(done, done[:-1] + least, side="left") - 1  # last sentence of the run from here
        back = np.searchsorted(done, done[1:] - least, side="right") - 1  # first sentence of the run to here
        some = self.words > 0
        first = np.concatenate([index[some], back[some]])
        last = np.concatenate([onward[some], index[some]])
        fits = (first >= 0) & (last < n)
        first, last = first[fits], last[fits]
        inside = self.owner[first] == self.owner[last]
        key = np.unique(first[inside] * n + last[inside])
        first, last = key // n, key % n
        out = []
        for base in BASES:
            power = powers(base, n + 1)
            inverse = powers(pow(base, -1, 1 << 64), n + 1)
            # sentences without words carry no content and no place, so that blank lines do not matter
            place = np.cumsum(self.words > 0)
            term = np.where(self.words > 0, self._hashes(base) * power[place], np.uint64(0))
            total = np.concatenate([[np.uint64(0)], np.cumsum(term, dtype=np.uint64)])
            start = place[first] - (self.words[first] > 0)
            out.append(mix64((total[last + 1] - total[first]) * inverse[start]).view(np.int64))
        return first, last, out[0], out[1]

    def doubled(self, first: np.ndarray, h1: np.ndarray) -> np.ndarray:
        """Spans that repeat an earlier one of the same text."""
        order = np.lexsort((first, h1, self.owner[first]))
        again = np.zeros(len(first), bool)
        same = (h1[order][1:] == h1[order][:-1]) & (self.owner[first[order]][1:] == self.owner[first[order]][:-1])
        again[order[1:][same]] = True
        return again


def _documents(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k"), F.xxhash64("text").alias("t"), "text")


def _first_places(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            key = piece.column("k").to_numpy()
            found = Sentences(piece.column("text").to_pylist())
            first, _, h1, h2 = found.spans(least)
            owner = key[found.owner[first]]
            order = np.lexsort((owner, h2, h1))
            h1, h2, owner = h1[order], h2[order], owner[order]
            fresh = np.ones(len(h1), bool)
            fresh[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(fresh)
            until = np.append(at[1:], len(h1)) - 1
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1[at]), pa.array(h2[at]), pa.array(owner[at]), pa.array(owner[until])],
                    ["h1", "h2", "low", "high"],
                )


def _repeated_spans(
    batches: Iterator[pa.RecordBatch], least: int, known: Bitmap
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            key, text = piece.column("k").to_numpy(), piece.column("t").to_numpy()
            found = Sentences(piece.column("text").to_pylist())
            first, last, h1, h2 = found.spans(least)
            local = found.doubled(first, h1)
            keep = np.flatnonzero(local | known.hits(h1))
            owner = found.owner[first[keep]]
            base = np.searchsorted(found.owner, owner, side="left")
            if len(keep):
                columns = [h1[keep], h2[keep], key[owner], text[owner], first[keep] - base, last[keep] - base]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in columns), pa.array(local[keep])], ["h1", "h2", "k", "t", "first", "last", "local"]
                )


def _remove(batches: Iterator[pa.RecordBatch], names: list[str], text: str) -> Iterator[pa.RecordBatch]:
    at = names.index(text)
    for batch in batches:
        for piece in slices(batch, text):
            texts = piece.column(at).to_pylist()
            found = Sentences(texts)
            begin = np.searchsorted(found.owner, np.arange(len(texts)), side="left")
            end = np.searchsorted(found.owner, np.arange(len(texts)), side="right")
            out, total, removed = [], (end - begin).astype(np.int32), np.zeros(len(texts), np.int32)
            for i, ranges in enumerate(piece.column("ranges").to_pylist()):
                if not ranges or texts[i] is None:
                    out.append(texts[i])
                    continue
                gone = np.zeros(total[i] + 1, np.int64)
                for r in ranges:
                    gone[r["first"]] += 1
                    gone[r["last"] + 1] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                removed[i] = gone.sum()
                keep = begin[i] + np.flatnonzero(~gone)
                out.append("".join(found.data[found.start[s] : found.end[s]].tobytes().decode() for s in keep))
            columns = [*piece.columns[:-1], pa.array(total), pa.array(removed)]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, [*names, "n", "r"])


def remove_repeats(df: DataFrame, least: int = SPAN_WORDS) -> DataFrame:
    """Take every sentence covered by a non-first repeated span out of ``text``; add n_sentences and n_removed.

    ``df`` has doc_id and text.  A span is a run of consecutive sentences with at least ``least`` words, the
    shortest from or to each sentence; two are equal if their words agree, A-Z in lower case.  The occurrence in
    the document with the smallest doc_id is the first, and in one document the earliest.  A null id comes after
    all others.  Rows with the same doc_id (or none) are versions of one document: what they share stays in all.
    Null and empty texts stay as they are, texts with fewer words have no span, and a document may end up empty.
    Other columns are kept; n_sentences and n_removed are replaced.

    The first pass counts span hashes (partly in each task, so a hot span shuffles once a batch); the second
    finds the spans again, lets only those through that a bitmap of the repeated ones knows, and joins them
    exactly.  That join is one adaptive execution can split where a passage is in a large share of the rows.
    """
    df = df.drop("n_sentences", "n_removed")
    source = _documents(df)
    counted = source.mapInArrow(lean(lambda b: _first_places(b, least)), "h1 long, h2 long, low long, high long")
    repeated = saved(
        counted.groupBy("h1", "h2")
        .agg(F.min("low").alias("origin"), F.max("high").alias("high"))
        .where(F.col("origin") != F.col("high"))
        .drop("high")
    )
    known = Bitmap(repeated, "h1")
    spans = source.mapInArrow(
        lean(lambda b: _repeated_spans(b, least, known)),
        "h1 long, h2 long, k long, t long, first long, last long, local boolean",
    )
    covered = (
        spans.join(repeated, ["h1", "h2"], "left")
        .where(F.col("local") | (F.col("origin") != F.col("k")))
        .groupBy("k", "t")
        .agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
        .withColumnsRenamed({"k": "k_", "t": "t_"})
    )
    names = [f"c{i}" for i in range(len(df.columns))]
    text = names[df.columns.index("text")]
    plain = df.toDF(*names)
    own = F.coalesce(plain[names[df.columns.index("doc_id")]].cast("long"), F.lit(LAST))
    joined = plain.join(
        covered, (own == F.col("k_")) & (F.xxhash64(text) == F.col("t_")), "left"
    ).drop("k_", "t_")
    schema = plain.schema.add("n", "integer").add("r", "integer")
    return joined.mapInArrow(lean(lambda b: _remove(b, names, text)), schema).toDF(*df.columns, "n_sentences", "n_removed")
