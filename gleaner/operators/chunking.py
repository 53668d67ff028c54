"""Split documents into overlapping chunks that keep their document's columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sizes in characters, and the break points tried from coarse to fine.
LEXICAL_SIZE, LEXICAL_OVERLAP = 1000, 100
SEMANTIC_SIZE, SEMANTIC_OVERLAP = 500, 100
BREAKS = ("\n\n", "\n", " ", "")


def chunk_fixed(
    documents: DataFrame, size: int, overlap: int, key: str = "parent_asin", text_col: str = "document"
) -> DataFrame:
    """Windows of ``size`` characters every ``size - overlap``; native and shuffle-free."""
    step = size - overlap
    length = F.char_length(text_col)
    # The last window starts where the one before it stops short of the end.
    last = F.greatest(F.ceil((length - overlap) / step).cast("int") - 1, F.lit(0))
    pieces = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(F.col(text_col), i * step + 1, F.lit(size)),
    )
    return _explode_chunks(documents.where(length > 0), pieces, key, text_col)


def chunk_recursive(
    documents: DataFrame,
    size: int = SEMANTIC_SIZE,
    overlap: int = SEMANTIC_OVERLAP,
    key: str = "parent_asin",
    text_col: str = "document",
) -> DataFrame:
    """Chunks that break at paragraphs, then lines, then words, then characters."""
    # Let Python see the text column only, in Arrow batches.
    split = F.pandas_udf(_splitter(size, overlap), "array<string>")
    return _explode_chunks(documents.where(F.col(text_col).isNotNull()), split(text_col), key, text_col)


def _explode_chunks(documents: DataFrame, pieces: Column, key: str, text_col: str) -> DataFrame:
    others = [c for c in documents.columns if c != text_col]
    return documents.select(*others, F.posexplode(pieces).alias("chunk_pos", "text")).withColumn(
        "chunk_id", F.format_string("%s#%06d", F.col(key).cast("string"), "chunk_pos")
    )


def _splitter(size: int, overlap: int):
    def split_column(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: split_text(text, size, overlap))

    return split_column


def split_text(text: str, size: int, overlap: int, breaks: tuple[str, ...] = BREAKS) -> list[str]:
    """Chunks of one text.  Depth is the number of break kinds, so recursion is shallow."""
    level = next(i for i, mark in enumerate(breaks) if mark == "" or mark in text)
    chunks: list[str] = []
    short: list[str] = []
    for piece in _cut(text, breaks[level]):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += _pack(short, size, overlap)
        short = []
        finer = breaks[level + 1 :]
        chunks += split_text(piece, size, overlap, finer) if finer else [piece]
    return chunks + _pack(short, size, overlap)


def _cut(text: str, mark: str) -> list[str]:
    """Pieces of ``text``; each later piece starts with the mark that precedes it."""
    if not mark:
        return list(text)
    head, *tail = text.split(mark)
    return [piece for piece in (head, *(mark + part for part in tail)) if piece]


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Greedy windows over ``pieces``: fill to ``size``, then slide, keeping up to ``overlap``."""
    chunks: list[str] = []
    start = total = 0
    for end, piece in enumerate(pieces):
        if total and total + len(piece) > size:
            chunks.append("".join(pieces[start:end]))
            while total > overlap or (total and total + len(piece) > size):
                total -= len(pieces[start])
                start += 1
        total += len(piece)
    chunks.append("".join(pieces[start:]))
    return [chunk for chunk in map(str.strip, chunks) if chunk]
