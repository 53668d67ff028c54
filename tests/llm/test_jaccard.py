"""Jaccard join and components against all pairs in plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import jaccard
from gleaner.llm.components import components

LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_set(text, n):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LETTERS))
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, rule):
    sets = [word_set(t, rule.n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if rule.parts * common >= rule.share * len(sets[i] | sets[j]):
                    parent[root(i)] = root(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def corpus(seed, groups=12, copies=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 30, 120, 300]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(text))
                text[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
                text = text or ["w"]
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return [(i * 7, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("rule", [jaccard.Similarity(3, 90, 100), jaccard.Similarity(5, 4, 5), jaccard.Similarity(1, 1, 2)])
def test_equals_all_pairs(spark, rows, rule):
    data = corpus(rule.n)
    data += [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (5, "one"), (None, "one"), (8, "a b"), (9, "A B")]
    data += [(10, "x " * 5000), (11, "x " * 6000), (None, "alone here")]
    df = spark.createDataFrame([(d, t, "z") for d, t in data], "doc_id long, text string, node string")
    got = rows(jaccard.near_duplicates(df, rule), "doc_id", "n_shingles", "component_id")
    assert got == brute(data, rule)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for _ in range(700):
        text = list(base)
        for _ in range(2):
            text[rng.randrange(len(text))] = f"v{rng.randrange(10**6)}"
        texts.append(" ".join(text))
    rule = jaccard.Similarity(3, 90, 100)
    data = list(enumerate(texts))
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.near_duplicates(df, rule).collect()), key=repr)
    assert len(got) == 700
    assert got == brute(data, rule)


@pytest.mark.parametrize("edits", [(0, 3, 6, 9), (8, 9, 10)])
def test_group_with_many_pairs_below_the_threshold(spark, monkeypatch, edits):
    """Most pairs share tiles and do not link; blocks are smaller than the group."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 40)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    data = []
    for i in range(250):
        text = list(base[: rng.choice([150, 150, 140, 120])])
        for _ in range(rng.choice(edits)):
            text[rng.randrange(len(text))] = f"v{rng.randrange(10**6)}"
        data.append((i, " ".join(text)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    for rule in (jaccard.Similarity(3, 90, 100), jaccard.Similarity(5, 4, 5)):
        got = sorted((tuple(r) for r in jaccard.near_duplicates(df, rule).collect()), key=repr)
        assert got == brute(data, rule)
        assert len({g[2] for g in got}) > 1


def test_keep_first(spark, rows):
    data = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "q r s"), (2, "a b c d e f g"), (None, "q r s"), (5, None)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(jaccard.keep_first(df)) == sorted([data[1], data[2], data[4], data[5]], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(df).count() == 0
    assert jaccard.keep_first(df).count() == 0


def test_tiles_meet_whatever_the_slices():
    """Any two linked sets share a tile key, also with many empty slices."""
    rng = np.random.default_rng(3)
    for rule in (jaccard.Similarity(3, 90, 100), jaccard.Similarity(5, 4, 5), jaccard.Similarity(1, 1, 2)):
        bands = rule.bands(3000)
        for size in (1, 2, 3, 5, 9, 10, 19, 20, 50, 333, 2000):
            for _ in range(20):
                a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
                drop = rng.integers(0, max(1, size // 4) + 1)
                add = rng.integers(0, max(1, size // 4) + 1)
                b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
                common = len(np.intersect1d(a, b))
                equal = common == len(a) == len(b)
                if len(b) and not equal and rule.linked(common, len(a) + len(b)):
                    x, y = (jaccard._tile_keys(0, s, rule, bands) for s in (a, b))
                    assert len(np.intersect1d(x, y))
                    bits = jaccard.signatures([a, b])
                    assert jaccard.may_link(bits[0], len(a), bits[1:], np.array([len(b)]), rule).all()
                    x, y = jaccard.sketch(a), jaccard.sketch(b)
                    width = min(len(x), len(y))
                    x, y = (z.reshape(width, -1).sum(axis=1, dtype=int) for z in (x, y))
                    assert np.abs(x - y).sum() <= len(a) + len(b) - 2 * common


def test_packed_keys_find_all_repeats():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 900, n)) for n in rng.integers(1, 200, 300)]
    texts += [t + " more" for t in texts[:100]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    rule, bits = jaccard.Similarity(3, 90, 100), 40
    bands = rule.bands(400)
    keys = np.concatenate([k for _, k in jaccard._slice_keys(batch, rule, bands)]) >> np.uint64(64 - bits)
    value, count = np.unique(keys, return_counts=True)
    packed = pa.Table.from_batches(jaccard._packed_keys([batch.slice(0, 250), batch.slice(250)], rule, bands, bits, 3)).to_pandas()
    found = [jaccard._repeated_keys(pa.table({"data": g["data"].tolist()})) for _, g in packed.groupby("bucket")]
    got = np.sort(np.concatenate([f.column("key").to_numpy() for f in found]))
    assert len(got) and (got == value[count > 1].view(np.int64)).all()


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (101, 100)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(61)) and found[100] == found[101] == 100


def test_links_that_come_out_differently_each_time(spark):
    """Components evaluate their links once."""
    from pyspark.sql import functions as F

    pairs = spark.range(400).select(
        F.col("id").alias("a"), F.when(F.rand() < 0.5, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("b")
    ).union(spark.createDataFrame([(0, 1)], "a long, b long"))
    assert {r["label"] for r in components(pairs).collect()} == {0}


@pytest.mark.parametrize("block", [jaccard.BLOCK_ROWS, 5])
def test_all_links_are_joined_and_counted(spark, rows, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    rule = jaccard.Similarity(3, 80, 100)
    data = corpus(11, groups=6, copies=9)
    data += [(1001, None), (1002, ""), (1004, "One"), (1005, "one"), (1005, "one"), (None, "one"), (1006, data[0][1])]
    sets = [word_set(t, rule.n) for _, t in data]
    linked = lambda a, b: rule.parts * len(a & b) >= rule.share * len(a | b)
    counts = [(d, len(a), sum(bool(a) and linked(a, b) for b in sets) - bool(a)) for (d, _), a in zip(data, sets)]
    first = {}
    for (d, _), a in zip(data, sets):
        first[a] = min(first.get(a, 1 << 60), 1 << 60 if d is None else d)
    pairs = {(x, y) for a, x in first.items() for b, y in first.items() if x < y and a and b and linked(a, b)}
    assert len(pairs) > len(first)  # many more than join the groups
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(jaccard.link_counts(df, rule), "doc_id", "n_shingles", "n_links") == sorted(counts, key=repr)
    assert rows(jaccard.similar_pairs(df, rule), "doc_a", "doc_b") == sorted(pairs, key=repr)
