"""Shared helpers: shingles against sets, slices, and the bitmap filter."""

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import common


def test_words_split_at_ascii_white_space_only():
    row, code, names = common.words(pa.array(["A b\u00a0c\x0b d", None, "", "\x1cB\x0cb"]))
    assert row.tolist() == [0, 0, 0, 3, 3]
    assert [names[c].as_py() for c in code] == ["a", "b\u00a0c", "d", "\x1cb", "b"]


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_shingles(size):
    texts = ["a b a b a b a", "x", "", "a b", "p q r s t u v"]
    row, code, names = common.words(pa.array(texts))
    owner, value = common.shingle_hashes(row, common.hash_strings(names)[code], len(texts), size)
    for i, text in enumerate(texts):
        words = text.split()
        whole = {tuple(words)} if 0 < len(words) < size else set()
        expected = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or whole
        mine = value[owner == i]
        assert len(mine) == len(expected) and (np.diff(mine.astype(object)) > 0).all()
    first, short = value[owner == 0], value[owner == 3]
    assert (len(np.intersect1d(first, short)) > 0) == (size <= 2)


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 90, 1, 1, 40)] + [None])], ["t"])
    cut = list(common.slices(batch, "t", 50))
    assert sum(c.num_rows for c in cut) == 7 and pa.Table.from_batches(cut).column(0).to_pylist() == batch.column(0).to_pylist()
    assert not list(common.slices(batch.slice(0, 0), "t"))


def test_bitmap(spark):
    members = [(i * 7919 - 40_000,) for i in range(3000)]
    seen = common.Bitmap(spark.createDataFrame([*members, (None,)], "k long").repartition(3), "k", 1 << 20)
    assert seen.hits(np.array([m[0] for m in members])).all()
    others = np.arange(10**12, 10**12 + 20_000)
    assert seen.hits(others).mean() < 0.01
    assert not common.Bitmap(spark.createDataFrame([], "k long"), "k", 1 << 10).hits(others).any()


def test_powers_invert():
    base = 0x9E3779B97F4A7C15
    product = common.powers(base, 50) * common.powers(pow(base, -1, 1 << 64), 50)
    assert (product == 1).all()
