"""Language identification by compression with one zstandard dictionary a language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import lean, slices

DICTIONARY_BYTES = 64 << 10
SAMPLE_TEXT_BYTES = 16 << 10
SAMPLE_TEXTS = 200
MAX_LANGUAGES = 500
CHUNK_BYTES = 1024
# matches from three bytes on: what languages share and differ in is short
SETTINGS = {
    "min_match": 3,
    "strategy": zstandard.STRATEGY_LAZY2,
    "window_log": 17,
    "chain_log": 17,
    "hash_log": 17,
    "search_log": 5,
    "target_length": 32,
    "write_content_size": 0,
    "write_checksum": 0,
    "write_dict_id": 0,
}
SHARPNESS = 50.0
NARROW = 0.003
LETTER = regex.compile(r"\p{L}")


def dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", seed: str = "doc_id") -> dict[str, bytes]:
    """Raw dictionary content for each language, from a bounded sample of the labelled rows.

    Of each language the first ``SAMPLE_TEXTS`` texts by a hash, among those that are not empty and have at most
    ``SAMPLE_TEXT_BYTES`` bytes, are taken whole until ``DICTIONARY_BYTES`` are full.  Null languages and texts
    are left out; equal texts count once.  More than ``MAX_LANGUAGES`` languages are an error.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(seed, text).alias("h"))
    size = F.octet_length("text")
    rows = rows.where(F.col("lang").isNotNull() & (size > 0) & (size <= SAMPLE_TEXT_BYTES))
    order = Window.partitionBy("lang").orderBy("h", "text")
    sample = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SAMPLE_TEXTS)
    languages = [r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out = {}
    for language in sorted(languages):
        content, seen = b"", set()
        texts = sample.where(F.col("lang") == language).select("text", "place").collect()
        for row in sorted(texts, key=lambda r: r["place"]):
            data = row["text"].lower().encode()
            if row["text"] not in seen and len(content) + len(data) <= DICTIONARY_BYTES:
                seen.add(row["text"])
                content += data + b"\n"
        out[language] = content
    return out


class Classifier:
    """Compressed size of a text, in lower case, under each language's dictionary."""

    def __init__(self, content: dict[str, bytes]):
        self.languages = sorted(content)
        self.coders = []
        settings = zstandard.ZstdCompressionParameters(**SETTINGS)
        for language in self.languages:
            options = {"compression_params": settings}
            if len(content[language]) >= 8:
                raw = zstandard.ZstdCompressionDict(content[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                raw.precompute_compress(compression_params=settings)
                options["dict_data"] = raw
            self.coders.append(zstandard.ZstdCompressor(**options))

    def sizes(self, text: str) -> np.ndarray:
        """Bytes over all chunks of the whole text; chunks are coded apart, so that a long text teaches none."""
        data = text.lower().encode()
        chunks = [data[i : i + CHUNK_BYTES] for i in range(0, len(data), CHUNK_BYTES)]
        return np.array([sum(len(coder.compress(c)) for c in chunks) for coder in self.coders], float)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin; ``und``, 0 and 0 without a letter or without any learned language."""
        if not text or not self.languages or not LETTER.search(text):
            return "und", 0.0, 0.0
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        excess = sizes / sizes[best] - 1
        margin = float(np.delete(excess, best).min()) if len(excess) > 1 else 1.0
        return self.languages[best], float(1 / np.exp(-SHARPNESS * excess).sum()), margin


def identify(df: DataFrame, content: dict[str, bytes], text: str = "text", narrow: float = NARROW) -> DataFrame:
    """Add lang_pred, lang_score (0 to 1), lang_margin and lang_rejected to every row.

    The language whose dictionary codes the whole text smallest wins; ties go to the first by name.  The margin
    is the second-best size over the best, less one.  Rejected are texts without a letter or null (``und``) and
    those with a margin below ``narrow``.  Columns of the same names are replaced; all others stay as they are.
    """
    df = df.drop("lang_pred", "lang_score", "lang_margin", "lang_rejected")
    at = df.columns.index(text)
    names = [f"c{i}" for i in range(len(df.columns))]
    schema = df.toDF(*names).schema.add("p", "string").add("s", "double").add("m", "double").add("r", "boolean")

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(content)
        for batch in batches:
            for piece in slices(batch, names[at]):
                found = [classifier(t) for t in piece.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *piece.columns,
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], pa.float64()),
                        pa.array([f[0] == "und" or f[2] < narrow for f in found], pa.bool_()),
                    ],
                    schema.fieldNames(),
                )

    return df.toDF(*names).mapInArrow(lean(classify), schema).toDF(
        *df.columns, "lang_pred", "lang_score", "lang_margin", "lang_rejected"
    )
