"""Edit-aware token counts: a tree of pre-token segments per document, updated where edits touch."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from gleaner.llm.common import BATCH_BYTES, slices

LEAF = 64
CONTEXT = 8
MEMORY = 400_000
# Fixed value: the pre-token pattern of the vocabulary's family; it must equal the tokenizer's.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Counter:
    """Token counts of pre-tokens under a byte-pair vocabulary, remembered for a bounded number of them."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.coder = tiktoken.Encoding("counter", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[piece] = len(self.coder.encode_ordinary(piece))
        return found


class Tree:
    """Sums of characters and tokens over the leaves (runs of pre-tokens) of one text.

    Level 0 holds the leaves; every node above sums two nodes below.
    """

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text = counter, text
        self.encoded = 0
        self.leaves = self._leaves(counter.split.findall(text))
        self._sum()

    def _leaves(self, pieces: list[str]) -> list[tuple[int, int]]:
        self.encoded += len(pieces)
        count = self.counter.count
        return [
            (sum(map(len, pieces[i : i + LEAF])), sum(map(count, pieces[i : i + LEAF])))
            for i in range(0, len(pieces), LEAF)
        ]

    def _sum(self) -> None:
        self.levels = [self.leaves]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            pairs = zip(below[::2], [*below[1::2], (0, 0)] if len(below) % 2 else below[1::2])
            self.levels.append([(a[0] + b[0], a[1] + b[1]) for a, b in pairs])

    @property
    def tokens(self) -> int:
        return self.levels[-1][0][1] if self.leaves else 0

    def _find(self, char: int) -> tuple[int, int]:
        """Leaf that holds a character, and where it starts; the last leaf for the end of the text."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            if char >= start + level[node][0] and node + 1 < len(level):
                start += level[node][0]
                node += 1
        return node, start

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace characters start to end (clipped to the text) by ``new`` and recount what that touches.

        The region begins at least a leaf and ``CONTEXT`` characters before ``start``: the pre-token before an
        edit may grow into it or end elsewhere, and a match looks few characters ahead.  It goes on until a pre-token of the new text ends where an old leaf ends behind
        the edit; from there on the old boundaries hold, as a match depends on what follows it alone.  Only
        the touched leaves and the sums above them are made anew.
        """
        start = max(0, min(start, len(self.text)))
        end = max(start, min(end, len(self.text)))
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]
        if not self.leaves:
            self.text, self.leaves = text, self._leaves(self.counter.split.findall(text))
            self._sum()
            return
        first, at = self._find(start)
        stop = first - 1
        while first > 0 and (first > stop or start - at < CONTEXT):
            first -= 1
            at -= self.leaves[first][0]
        last, behind = self._find(end)
        behind += self.leaves[last][0]
        pieces, place = [], at
        for match in self.counter.split.finditer(text, at):
            pieces.append(match.group())
            place = match.end()
            while last + 1 < len(self.leaves) and behind + shift < place:
                last += 1
                behind += self.leaves[last][0]
            if place == behind + shift and behind > end:
                break
        else:
            last = len(self.leaves) - 1
        self.text = text
        made = self._leaves(pieces)
        same = len(made) == last + 1 - first
        self.leaves[first : last + 1] = made
        if same:
            self._update(first, last)
        else:
            self._sum()

    def _update(self, first: int, last: int) -> None:
        for below, level in zip(self.levels, self.levels[1:]):
            first, last = first // 2, last // 2
            for i in range(first, last + 1):
                a = below[2 * i]
                b = below[2 * i + 1] if 2 * i + 1 < len(below) else (0, 0)
                level[i] = (a[0] + b[0], a[1] + b[1])


def count_edited(documents: DataFrame, edits: DataFrame, vocabulary: str) -> DataFrame:
    """Token counts before and after a list of edits, per document row.

    ``documents`` has doc_id and text; ``edits`` has doc_id, seq, start, end (characters) and new.  Edits of a
    document are applied by seq, then by their other fields, to every row with that id; equal edits are applied
    once each.  A null ``new`` deletes, null bounds are 0 and bounds beyond the text are clipped; edits without a
    document, or with a null id, change nothing.  A null text counts as empty and is returned as null.

    Adds n_tokens_before, n_tokens (after), n_pretokens (of the first count), n_recounted (pre-tokens encoded for
    the edits), n_leaves and edited_text.  ``vocabulary`` is the path of a tiktoken file that every executor can
    read.  One document's edits are a list in one row: they build on each other.
    """
    step = F.struct("seq", F.coalesce("start", F.lit(0)).cast("long").alias("start"),
                    F.coalesce("end", F.lit(0)).cast("long").alias("end"), F.coalesce("new", F.lit("")).alias("new"))
    lists = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(step)).alias("edits_"))
    source = documents.select("doc_id", "text")
    key = source.schema["doc_id"].dataType

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in slices(batch, "text"):
                texts = [None if t is None else coder.compress(t.encode()) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "packed"])

    # Texts go through the shuffle compressed: they are almost all of what it moves.
    packed = source.mapInArrow(pack, StructType([StructField("doc_id", key), StructField("packed", BinaryType())]))
    rows = packed.join(lists, "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, coder = Counter(vocabulary), zstandard.ZstdDecompressor()
        for batch in batches:
            for piece in slices(batch, "packed", BATCH_BYTES // 4):
                out: list[tuple] = []
                texts = [None if t is None else coder.decompress(t).decode() for t in piece.column("packed").to_pylist()]
                for text, steps in zip(texts, piece.column("edits_").to_pylist()):
                    tree = Tree(counter, text or "")
                    before, pieces = tree.tokens, tree.encoded
                    for s in steps or ():
                        tree.edit(s["start"], s["end"], s["new"])
                    edited = None if text is None and not steps else tree.text
                    out.append((before, tree.tokens, pieces, tree.encoded - pieces, len(tree.leaves), edited))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        *(pa.array(c, pa.int64()) for c in columns[:5]),
                        pa.array(columns[5], pa.string()),
                    ],
                    [f.name for f in schema.fields],
                )

    schema = rows.select("doc_id").schema
    for name in ("n_tokens_before", "n_tokens", "n_pretokens", "n_recounted", "n_leaves"):
        schema = schema.add(name, "long")
    schema = schema.add("edited_text", "string")
    return rows.mapInArrow(run, schema)
