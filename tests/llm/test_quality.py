"""The line chain against enumeration, edge cases, and held-out accuracy."""

from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import quality, queries

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 5, 0, 2])
    emission, transition = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    good, steps = quality.marginals(emission, lengths, transition)
    at = 0
    for d, n in enumerate(lengths):
        total, mass, moves = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in product((0, 1), repeat=int(n)):
            score = sum(e for e, s in zip(emission[at : at + n], path) if s)
            score += sum(transition[a, b] for a, b in zip(path, path[1:]))
            p = np.exp(score)
            total += p
            mass += p * np.array(path)
            for a, b in zip(path, path[1:]):
                moves[a, b] += p
        if n:
            assert good[at : at + n] == pytest.approx(mass / total)
            assert steps[d] == pytest.approx(moves / total)
        at += n


def test_line_features():
    per_document, size, x = quality.line_features(pa.array(["Ab 1\n\n%%", None, "", "é z"]))
    assert per_document.tolist() == [3, 1, 1, 1]
    assert size.tolist() == [5, 1, 3, 1, 1, 7]
    assert x.shape == (6, quality.WIDTH)
    assert x[0, :4] == pytest.approx([0.5, 0.5, 0.25, 0.25])
    assert x[0, quality.OWN : 2 * quality.OWN].tolist() == [0] * quality.OWN
    assert x[1, quality.OWN : 2 * quality.OWN] == pytest.approx(x[0, : quality.OWN])


def test_edges(spark):
    rng = np.random.default_rng(1)
    good = [" ".join("word" + str(rng.integers(99)) for _ in range(30)) + "." for _ in range(30)]
    bad = [" ".join("%%$$" for _ in range(30)) for _ in range(30)]
    data = [(i, t, 1) for i, t in enumerate(good)] + [(100 + i, t, 0) for i, t in enumerate(bad)]
    data += [(500, "unused", None), (501, None, 1), (None, "some plain words.", 1)]
    known = spark.createDataFrame(data, "doc_id long, text string, quality int")
    model = quality.train(known, known.select("doc_id", "quality"))
    texts = [good[0], bad[0], None, "", "\n" * 5000, good[1] + "\n" + bad[1], "line of words.\n" * 20_000]
    df = spark.createDataFrame([(i, t, 7.0) for i, t in enumerate(texts)], "doc_id long, text string, quality_score double")
    score = [r["quality_score"] for r in quality.score(df, model).orderBy("doc_id").collect()]
    assert all(0 <= s <= 1 for s in score) and score[0] > 0.8 and score[1] < 0.2 and score[2] == score[3]
    assert score[1] < score[5] < score[0]
    assert quality.score(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string, quality int")
    model = quality.train(none, none.select("doc_id", "quality"))
    df = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    assert quality.score(df, model).first()["quality_score"] == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    found = queries.op9_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    held = found[found["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    assert held[held["quality"] == 1]["score"].mean() > 0.9 > held[held["quality"] == 0]["score"].mean() + 0.5
