"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import saved, slices, words

SAMPLE_PER_LABEL = 3000
ROUNDS = 40
RATE = 0.3
DECAY = 1e-3
OWN = 10
WIDTH = 3 * OWN + 3  # a line's own features, its neighbours', first line, last line, bias


def _classes() -> np.ndarray:
    """Class of each byte: 0 letter, 1 capital, 2 digit, 3 white space, 4 sentence mark, 5 other."""
    out = np.full(256, 5, np.uint8)
    out[128:] = 0
    for low, high, kind in (("a", "z", 0), ("A", "Z", 1), ("0", "9", 2)):
        out[ord(low) : ord(high) + 1] = kind
    out[[9, 10, 11, 12, 13, 32]] = 3
    out[[ord(c) for c in ".,;:?'\"()-"]] = 4
    return out


CLASSES = _classes()


def line_features(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines per document, bytes per line (its break included) and the feature matrix, line by line.

    A text is cut at every newline; null and empty texts are one empty line.
    """
    lists = pc.split_pattern(pc.fill_null(text, ""), "\n")
    lines = pc.list_flatten(lists)
    per_document = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(lines)
    size = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pc.binary_join_element_wise(lines, "", "\n").to_pylist()
    data = CLASSES[np.frombuffer("".join(joined).encode(), np.uint8)]
    starts = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    count = np.stack([np.add.reduceat(data == k, starts, dtype=np.int64) if n else np.zeros(0) for k in range(6)], axis=1)
    count[:, 3] -= 1  # the break
    row, code, _ = words(lines)
    tokens = np.bincount(row, minlength=n)
    pair = np.unique(row * (int(code.max(initial=0)) + 1) + code)
    distinct = np.bincount(pair // (int(code.max(initial=0)) + 1), minlength=n)
    some, letters = np.maximum(size, 1), np.maximum(count[:, 0] + count[:, 1], 1)
    own = np.stack(
        [
            (count[:, 0] + count[:, 1]) / some,
            count[:, 1] / letters,
            count[:, 2] / some,
            count[:, 3] / some,
            count[:, 4] / some,
            count[:, 5] / some,
            np.log1p(size) / 8,
            np.minimum(size / np.maximum(tokens, 1) / 10, 3),
            1 - distinct / np.maximum(tokens, 1),
            (tokens == 0).astype(float),
        ],
        axis=1,
    )
    ends = np.cumsum(per_document)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ends - per_document], last[ends - 1] = True, True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    return per_document, size + 1, np.hstack([own, before, after, first[:, None], last[:, None], np.ones((n, 1))])


def _log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def marginals(
    emission: np.ndarray, per_document: np.ndarray, transition: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each line is good, and the expected number of steps between states, by document.

    ``emission`` is the score of good over bad; forward and backward passes run over all documents of the batch
    at once, position by position.
    """
    order = np.argsort(-per_document, kind="stable")
    start = (np.cumsum(per_document) - per_document)[order]
    length = per_document[order]
    longest = int(length.max(initial=0))
    active = np.searchsorted(-length, -np.arange(longest), side="left")
    n = len(emission)
    score = np.stack([np.zeros(n), emission], axis=1)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    for t in range(longest):
        at = start[: active[t]] + t
        if t == 0:
            ahead[at] = score[at]
        else:
            from_ = ahead[at - 1]
            for j in (0, 1):
                ahead[at, j] = _log_add(from_[:, 0] + transition[0, j], from_[:, 1] + transition[1, j]) + score[at, j]
    for t in range(longest - 2, -1, -1):
        at = start[: active[t + 1]] + t
        onward = back[at + 1] + score[at + 1]
        for i in (0, 1):
            back[at, i] = _log_add(transition[i, 0] + onward[:, 0], transition[i, 1] + onward[:, 1])
    both = ahead + back
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    total = _log_add(both[:, 0], both[:, 1])
    inner = np.ones(n, bool)
    inner[start[length > 0]] = False
    at = np.flatnonzero(inner)
    steps = np.zeros((len(per_document), 2, 2))
    document = np.repeat(np.arange(len(per_document)), per_document)[at]
    for i in (0, 1):
        for j in (0, 1):
            log = ahead[at - 1, i] + transition[i, j] + score[at, j] + back[at, j] - total[at]
            steps[:, i, j] = np.bincount(document, np.exp(np.minimum(log, 0)), minlength=len(per_document))
    return good, steps


def sample(labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """At most ``per_label`` rows of either label, the first by a hash of the id; null labels and ids left out.

    ``labels``: doc_id, quality.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    known = labels.where("doc_id is not null").select("doc_id", F.col("quality").cast("int").alias("y"))
    bad, good = (known.where(F.col("y") == y).orderBy(*order).limit(per_label) for y in (0, 1))
    return bad.unionByName(good)


def train(
    documents: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL, rounds: int = ROUNDS
) -> dict[str, np.ndarray]:
    """Fit emission and transition weights by maximum likelihood; every line carries its document's label.

    ``documents`` has doc_id and text.  Each round sums gradients per partition over a bounded sample of
    whole documents; documents count by the root of their number of lines.  Without labelled rows all weights
    are zero and every score is 0.5.
    """
    # at most two times per_label rows are broadcast, so no text is shuffled
    rows = saved(documents.select("doc_id", "text").join(F.broadcast(sample(labels, per_label)), "doc_id").select("text", "y"))
    weight, transition = np.zeros(WIDTH), np.zeros((2, 2))
    first, second = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)

    def prepared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                per_document, _, x = line_features(piece.column("text"))
                ends = np.cumsum(per_document)
                cut = [x[e - k : e].astype(np.float32).tobytes() for k, e in zip(per_document, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary()), piece.column("y")], ["x", "y"])

    stored = saved(rows.mapInArrow(prepared, "x binary, y int"))

    def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH + 5)
        for batch in batches:
            parts = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in batch.column("x").to_pylist()]
            per_document = np.array([len(p) for p in parts], np.int64)
            x, y = np.vstack(parts).astype(float), batch.column("y").to_numpy(zero_copy_only=False)
            good, steps = marginals(x @ weight, per_document, transition)
            count = 1 / np.sqrt(per_document)
            total[:WIDTH] += x.T @ ((np.repeat(y, per_document) - good) * np.repeat(count, per_document))
            seen = np.zeros_like(steps)
            seen[np.arange(len(y)), y, y] = per_document - 1
            total[WIDTH:-1] += ((seen - steps) * count[:, None, None]).sum(axis=0).ravel()
            total[-1] += np.sqrt(per_document).sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["g"])

    for step in range(1, rounds + 1):
        parts = [r["g"] for r in stored.mapInArrow(gradient, "g array<double>").collect()]
        total = np.array(sorted(parts)).sum(axis=0) if parts else np.zeros(WIDTH + 5)
        if not total[-1]:
            break
        g = total[:-1] / total[-1] - DECAY * np.concatenate([weight, transition.ravel()])
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weight, transition = weight + move[:WIDTH], transition + move[WIDTH:].reshape(2, 2)
    return {"weight": weight, "transition": transition}


def score(df: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """Add quality_score (0 to 1, the mean over all lines of the probability of good, by length) and quality_lines.

    The whole text is read.  Null and empty texts are one empty line and get that line's probability.  Columns of
    the same names are replaced; all others stay as they are.
    """
    df = df.drop("quality_score", "quality_lines")
    at = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))]
    schema = df.toDF(*names).schema.add("s", "double").add("n", "integer")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, names[at]):
                per_document, size, x = line_features(piece.column(at))
                good, _ = marginals(x @ model["weight"], per_document, model["transition"])
                document = np.repeat(np.arange(piece.num_rows), per_document)
                share = np.bincount(document, good * size) / np.bincount(document, size)
                extra = [pa.array(np.clip(share, 0, 1)), pa.array(per_document.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*piece.columns, *extra], schema.fieldNames())

    return df.toDF(*names).mapInArrow(judge, schema).toDF(*df.columns, "quality_score", "quality_lines")
