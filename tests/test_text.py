import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.functions import display
from gleaner.functions.text import (
    after_marker,
    is_blank,
    strip_think,
    strip_ws,
    tokenise,
    tokenise_lower,
    tokeniser_without,
)

SPACES = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　"
TEXTS = st.lists(
    st.text(alphabet=st.sampled_from("aB<>/. |é" + SPACES + "\U0001f600"), max_size=30), min_size=1, max_size=40
)


def column(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.select(expression, "i").orderBy("i").collect()]


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_white_space_like_python(spark, texts):
    assert column(spark, texts, tokenise(F.col("v"))) == [t.split() for t in texts]
    assert column(spark, texts, strip_ws(F.col("v"))) == [t.strip() for t in texts]
    assert column(spark, texts, is_blank(F.col("v"))) == [not t.strip() for t in texts]


def test_case_is_kept_unless_asked(spark):
    assert column(spark, ["Wireless MOUSE, wireless"], tokenise(F.col("v"))) == [["Wireless", "MOUSE,", "wireless"]]
    assert column(spark, ["Wireless MOUSE"], tokenise_lower(F.col("v"))) == [["wireless", "mouse"]]


def test_stop_words_and_punctuation(spark):
    tokens = tokeniser_without(["the"])(F.col("v"))
    assert column(spark, ["The best, the REST!", "the"], tokens) == [["best", "rest"], []]
    assert column(spark, ["The best"], tokeniser_without([])(F.col("v"))) == [["the", "best"]]


def test_markers_like_python(spark):
    texts = ["plain ", "a</think>\n b </think> c", "</think>", "x </think>", "Assistant: one Assistant: two"]
    expected = [t.split("</think>", 1)[-1].strip() for t in texts]
    assert column(spark, texts, after_marker(F.col("v"), "</think>")) == expected
    expected = [t.split("Assistant:", 1)[-1].strip() for t in texts]
    assert column(spark, texts, after_marker(F.col("v"), "Assistant:")) == expected


def test_reasoning_spans_like_python(spark):
    texts = [
        "<think>a\nb</think> answer",
        "x <think>1</think> y <think>2\n\n</think> z",
        "<think>open only",
        "none",
        "<think></think>",
    ]
    expected = [re.sub(r"<think>.*?</think>", "", t, flags=re.DOTALL).strip() for t in texts]
    assert column(spark, texts, strip_think(F.col("v"))) == expected


def test_one_decimal_like_python(spark):
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.65, 0.75, 4.25, 4.35, 4.75, 4.95, 4.85, 0.29999999999999998]
    values += [i / 100 for i in range(0, 2000)] + [i / 8 for i in range(400)] + [i / 7 for i in range(400)]
    assert column(spark, values, display.one_decimal(F.col("v")), "double") == [f"{v:.1f}" for v in values]


def test_labels(spark):
    assert column(spark, [4.25, None], display.rating_label(F.col("v")), "double") == ["Rating: 4.2", None]
    assert column(spark, [3], display.rank_label(F.col("v")), "int") == ["#3"]
    assert column(spark, [1.23456], display.score_label(F.col("v")), "double") == ["1.2346"]


def test_short_title_counts_characters(spark):
    long = "\U0001f600" * 101
    assert column(spark, [long, None], display.short_title(F.col("v"))) == [long[:100], None]


def test_nested_fields(spark):
    arrays = [["a", None, "b"], [], None]
    assert column(spark, arrays, display.flat_array(F.col("v")), "array<string>") == ["a b", "", None]
    maps = [{"k": "1"}, {}, None]
    assert column(spark, maps, display.flat_map(F.col("v")), "map<string,string>") == ["k 1", " ", None]
    json = ['{"rank": {"Phones": 3}, "colour": "red"}']
    assert column(spark, json, display.flat_map(display.json_map(F.col("v")))) == ['rank colour {"Phones":3} red']


def test_hit_block_defaults(spark):
    block = display.hit_block(F.col("v"), F.lit(None).cast("string"), F.lit(4.5), F.lit("text"))
    assert column(spark, [None, "B1"], block) == [
        "Product ASIN: N/A\nTitle: N/A\nAverage Rating: 4.5\nContent: text\n",
        "Product ASIN: B1\nTitle: N/A\nAverage Rating: 4.5\nContent: text\n",
    ]
