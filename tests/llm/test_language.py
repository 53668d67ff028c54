"""Language identification: edge cases and held-out accuracy."""

from gleaner.llm import language, queries

SF = "/root/testdata/sf0.01"


def content():
    return {
        "en": b"the cat sat on the mat and the dog ran over the hill with the other dogs " * 20,
        "de": "der hund lief über den hügel und die katze saß auf der matte mit den anderen ".encode() * 20,
    }


def test_edges(spark):
    texts = ["the dog sat on the hill", "die katze lief über die matte", None, "", "12 + 34 = 46 !!", "x", "the dog " * 50_000]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    found = language.identify(df, content()).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in found][:5] == ["en", "de", "und", "und", "und"]
    assert found[6]["lang_pred"] == "en"
    assert all(0 <= r["lang_score"] <= 1 for r in found)
    assert [r["lang_rejected"] for r in found][2:5] == [True] * 3
    assert [r["text"] for r in found] == texts


def test_nothing_learnt(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.dictionaries(none) == {}
    df = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert language.identify(df, {}).first()["lang_pred"] == "und"
    assert language.identify(none, content()).count() == 0


def test_dictionaries_are_bounded_and_skip_nulls(spark):
    data = [(i, f"text {i} " * 900, "a") for i in range(60)] + [(None, "x y", "b"), (70, None, "b"), (71, "z", None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    made = language.dictionaries(df)
    assert set(made) == {"a", "b"} and made["b"] == b"x y\n"
    assert len(made["a"]) <= language.DICTIONARY_BYTES + 60


def test_held_out_accuracy(spark):
    found = queries.op6_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = found.where("held_out").toPandas()
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert found.where("rejected").count() <= 0.02 * found.count()
