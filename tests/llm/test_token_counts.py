"""Edited counts against encoding the edited text as a whole."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm import queries, token_counts

PATH = queries.vocabulary_path()
COUNTER = token_counts.Counter(PATH)
ALPHABET = "ab c'sltrev 12é,.!\n\t  "


def whole(text):
    return len(COUNTER.coder.encode_ordinary(text))


@settings(max_examples=120, deadline=None)
@given(
    st.text(ALPHABET, max_size=900),
    st.lists(st.tuples(st.integers(0, 950), st.integers(0, 60), st.text(ALPHABET, max_size=40)), max_size=6),
)
def test_edits_equal_whole_counts(text, edits):
    tree = token_counts.Tree(COUNTER, text)
    assert tree.tokens == whole(text)
    for start, length, new in edits:
        at = min(start, len(text))
        text = text[:at] + new + text[min(at + length, len(text)) :]
        tree.edit(start, start + length, new)
        assert tree.text == text
        assert sum(c for c, _ in tree.leaves) == len(text)
        assert tree.tokens == whole(text)


def test_only_a_part_is_counted_again():
    rng = random.Random(1)
    text = " ".join(f"word{rng.randrange(100)}" for _ in range(20_000))
    tree = token_counts.Tree(COUNTER, text)
    first = tree.encoded
    tree.edit(50_000, 50_005, "new words here")
    assert tree.encoded - first < 500
    assert tree.tokens == whole(tree.text)


def test_rows(spark):
    docs = [(1, "one two three", "x"), (2, None, "x"), (3, "", "x"), (None, "no id", "x"), (1, "other text", "x")]
    edits = [
        (1, 1, 0, 3, "uno"), (1, 2, -5, 0, ">> "), (1, 3, 999, 1000, " end"), (2, 1, 0, 5, "made"),
        (3, 1, None, None, None), (9, 1, 0, 1, "lost"), (None, 1, 0, 1, "lost"),
    ]
    found = token_counts.count_edited(
        spark.createDataFrame(docs, "doc_id long, text string, new string"),
        spark.createDataFrame(edits, "doc_id long, seq int, start long, end long, new string"),
        PATH,
    ).collect()
    by = {(r["doc_id"], r["edited_text"]): (r["n_tokens_before"], r["n_tokens"]) for r in found}
    expected = {
        (1, ">> uno two three end"): (whole("one two three"), whole(">> uno two three end")),
        (1, ">> unoer text end"): (whole("other text"), whole(">> unoer text end")),
        (2, "made"): (0, whole("made")), (3, ""): (0, 0), (None, "no id"): (whole("no id"),) * 2,
    }
    assert by == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    edits = spark.createDataFrame([], "doc_id long, seq int, start long, end long, new string")
    assert token_counts.count_edited(docs, edits, PATH).count() == 0


def test_query_equals_whole_counts(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = token_counts.count_edited(documents, queries.derived_edits(documents), PATH).collect()
    assert len(found) == documents.count()
    assert all(r["n_tokens"] == whole(r["edited_text"]) for r in found)


@pytest.mark.parametrize("memory", [1, 400_000])
def test_bounded_memory_counts_alike(monkeypatch, memory):
    monkeypatch.setattr(token_counts, "MEMORY", memory)
    counter = token_counts.Counter(PATH)
    assert token_counts.Tree(counter, "some words, some more words").tokens == whole("some words, some more words")
