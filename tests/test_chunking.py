import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.operators.chunking import chunk_fixed, chunk_recursive, split_text

# Worked by hand from the rule: break coarse to fine, fill to the size, slide back to the overlap.
CASES = [
    ("", 10, 3, []),
    ("   ", 10, 3, []),
    ("short", 10, 3, ["short"]),
    ("aaa bbb ccc ddd", 7, 0, ["aaa bbb", "ccc", "ddd"]),  # the blank before a word counts
    ("aaa bbb ccc ddd", 8, 0, ["aaa bbb", "ccc ddd"]),
    ("aaa bbb ccc ddd", 8, 4, ["aaa bbb", "bbb ccc", "ccc ddd"]),
    ("one\n\ntwo three four", 10, 0, ["one", "two three", "four"]),
    ("abcdefghij", 4, 1, ["abcd", "defg", "ghij"]),
    ("ab abcdefghij cd", 4, 0, ["ab", "abc", "defg", "hij", "cd"]),
    ("line one\nline two\nline three", 18, 0, ["line one\nline two", "line three"]),
]


@pytest.mark.parametrize("text,size,overlap,expected", CASES)
def test_worked_cases(text, size, overlap, expected):
    assert split_text(text, size, overlap) == expected


@settings(max_examples=300, deadline=None)
@given(
    st.text(alphabet="ab \n", max_size=200),
    st.integers(min_value=2, max_value=40),
    st.integers(min_value=0, max_value=20),
)
def test_chunks_are_bounded_pieces_of_the_text(text, size, overlap):
    chunks = split_text(text, size, min(overlap, size - 1))
    assert all(0 < len(c) <= size for c in chunks)
    assert all(c in text for c in chunks)
    # Without overlap nothing but white space is lost.
    plain = split_text(text, size, 0)
    assert "".join("".join(plain).split()) == "".join(text.split())


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abc \n", max_size=300), st.integers(1, 50), st.integers(0, 49))
def test_recursive_depth_and_order(text, size, overlap):
    chunks = split_text(text, size, min(overlap, size - 1))
    position = 0
    for chunk in chunks:
        found = text.find(chunk, max(0, position - size))
        assert found >= 0
        position = found


def test_frame_keeps_document_columns(spark, rows):
    df = spark.createDataFrame(
        [("p1", "T1", "aaa bbb ccc ddd"), ("p2", "T2", ""), ("p3", "T3", None)],
        "parent_asin string, product_title string, document string",
    )
    got = chunk_recursive(df, 8, 4)
    assert rows(got, "chunk_id", "chunk_pos", "parent_asin", "product_title", "text") == [
        ("p1#000000", 0, "p1", "T1", "aaa bbb"),
        ("p1#000001", 1, "p1", "T1", "bbb ccc"),
        ("p1#000002", 2, "p1", "T1", "ccc ddd"),
    ]


def test_fixed_chunks_rebuild_the_text(spark):
    texts = ["", "a", "x" * 7, "\U0001f600bcdefghij" * 9, "y" * 10, "z" * 14]
    df = spark.createDataFrame(list(enumerate(texts)), "parent_asin int, document string")
    for size, overlap in [(10, 0), (10, 3), (5, 4)]:
        chunks = chunk_fixed(df, size, overlap)
        pieces = {}
        for r in chunks.orderBy("parent_asin", "chunk_pos").collect():
            pieces.setdefault(r["parent_asin"], []).append(r["text"])
        for i, text in enumerate(texts):
            got = pieces.get(i, [])
            rebuilt = "".join(p if n == 0 else p[overlap:] for n, p in enumerate(got))
            assert rebuilt == text
            assert all(len(p) <= size for p in got)
        assert chunks.where(F.char_length("text") == 0).count() == 0
