"""Targets by hand and the balance of the cube sample."""

import numpy as np
import pytest

from gleaner.llm import mixing


def target_table(spark, sizes, weights, share=1.5, most=2.0):
    sources = spark.createDataFrame(sizes, "source string, source_size long")
    return {s: t for s, _, t in mixing.targets(mixing.cycled_weights(sources, weights), share, most)}


def test_targets_are_dealt_again(spark):
    # 150 % of 1000 over weights 3, 1, 2: b's 250 fits 700; a stops at 2 * 100, c at 2 * 200, the rest goes to b
    found = target_table(spark, [("a", 100), ("b", 700), (None, 200)], [3.0, 1.0, 2.0])
    assert found == {"a": 200.0, None: 400.0, "b": pytest.approx(900.0)}


def test_targets_undealt_rest(spark):
    assert target_table(spark, [("a", 10)], [3.0], share=5.0) == {"a": 20.0}
    assert target_table(spark, [("a", 0), ("b", 10)], [1.0, 1.0]) == {"a": 0.0, "b": pytest.approx(15.0)}


def test_flight_keeps_sums():
    rng = np.random.default_rng(1)
    size = rng.integers(0, 5000, 3000)
    pi = np.full(3000, 0.37)
    flown = mixing.fly(pi, size.tolist(), rng)
    assert ((flown > mixing.EPSILON) & (flown < 1 - mixing.EPSILON)).sum() <= 2
    assert flown.sum() == pytest.approx(pi.sum())
    assert (flown * size).sum() == pytest.approx((pi * size).sum())
    assert set(np.unique(mixing.land(flown, size.astype(float)))) <= {0.0, 1.0}


def test_inclusion_is_unbiased():
    size = [3, 100, 40, 7, 900, 12]
    total = sum(mixing.fly(np.full(6, 0.3), size, np.random.default_rng(s)) for s in range(4000)) / 4000
    assert np.abs(total - 0.3).max() < 0.04


def test_mix(spark):
    rng = np.random.default_rng(4)
    data = [(i, ["x", "y", None, "hot"][min(3, i % 9)], int(rng.integers(1, 2000)), "c") for i in range(9000)]
    data += [(None, "x", 5, "c"), (None, "x", 5, "c"), (20_000, "zero", 0, "c"), (20_001, "zero", 0, "c")]
    df = spark.createDataFrame(data, "doc_id long, source string, size long, block string")
    clashing = df.selectExpr("*", "'x' as target", "1 as row_id", "2 as c0", "3 as pi", "4 as copies")
    first = mixing.mix(clashing, [3.0, 1.0, 2.0], 1.5, 2.0).toPandas()
    assert first["row_id"].eq(1).all() and first["c0"].eq(2).all() and first["block"].eq("c").all()
    assert len(first) == len(data) and first["copies"].max() <= 2
    for source, group in first.groupby("source", dropna=False):
        taken = (group["copies"] * group["size"]).sum()
        assert taken == pytest.approx(group["target"].iloc[0], abs=2 * 2000)
        assert group["source_size"].iloc[0] == group["size"].sum()
    again = mixing.mix(df.repartition(7), [3.0, 1.0, 2.0], 1.5, 2.0).toPandas()
    key = ["doc_id", "source", "size"]
    assert first.groupby(key, dropna=False)["copies"].sum().equals(again.groupby(key, dropna=False)["copies"].sum())


def test_large_documents_do_not_land(spark):
    """With a few documents of a hundred times the others' size, every source comes within 1 % of its target."""
    rng = np.random.default_rng(11)
    data = [(i, f"s{i % 6}", int(rng.integers(20, 300))) for i in range(1200)]
    data += [(5000 + i, f"s{i % 6}", int(rng.integers(9000, 20000))) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, source string, size long")
    mixed = mixing.mix(df, [3.0, 1.0, 2.0], 1.5, 2.0).toPandas()
    for _, group in mixed.groupby("source"):
        assert (group["copies"] * group["size"]).sum() == pytest.approx(group["target"].iloc[0], rel=0.01)


def test_words_and_empty(spark):
    df = spark.createDataFrame([("a  b\tc\n",), ("",), (None,), ("\u00a0x y",)], "text string")
    assert [r[0] for r in df.select(mixing.word_count("text")).collect()] == [3, 0, 0, 2]
    none = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(none, [1.0], 1.5, 2.0).count() == 0
