"""Hard negatives against brute force, with ties, copies, hot labels and odd vectors."""

import math
import random

import pytest

from gleaner.llm import hard_negatives as hn

KIND = "vec_id long, embedding array<double>, label int"


def brute(data, is_anchor, per_anchor=5, per_positive=10, scale=256):
    good = [
        (i, [math.floor(scale * c) for c in v], label)
        for i, v, label in data
        if None not in (i, v, label) and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for i, v, label in good:
        if not is_anchor(i):
            continue
        near = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in good if j != i and len(w) == len(v))
        for p, positive, _ in [r for r in near if r[2] == label][:per_anchor]:
            fits = [r for r in near if r[2] != label and 30 * -p <= 100 * -r[0] <= 90 * -p]
            out += [(i, positive, rank + 1, j, -p, -s) for rank, (s, j, _) in enumerate(fits[:per_positive])]
    return sorted(out)


def mined(spark, data, anchors, **options):
    rows = hn.integer_rows(spark.createDataFrame(data, KIND), "vec_id", "embedding", "label")
    return sorted(tuple(r) for r in hn.mine(rows, rows.where(anchors), **options).collect())


@pytest.mark.parametrize("options", [{}, {"anchor_bytes": 700}, {"partitions": 1}])
def test_equals_brute_force(spark, options):
    rng = random.Random(3)
    data = [(i, [rng.gauss(0, 1) for _ in range(4)], rng.choice([0, 0, 1, 2, 3])) for i in range(400)]
    data += [(400 + i, data[20][1], i % 3) for i in range(60)]  # ties
    data += [(30, data[31][1], 1), (30, data[31][1], 1), (41, data[41][1], 0)] * 2  # repeated ids, also of anchors
    data += [(500, None, 1), (510, [1.0, None], 1), (520, [math.nan] * 4, 1), (530, [math.inf] * 4, 1), (None, [0.0] * 4, 1)]
    data += [(540, [1.0] * 4, None), (550, [1.0, 2.0], 1), (551, [3.0, -1.0], 0), (552, [3.0, 1.0], 1), (560, [], 1), (561, [], 1)]
    data += [(570, [0.0] * 4, 2), (562, [], 2), (580, [-1.0] * 4, -5)]
    assert mined(spark, data, "id % 10 = 0", **options) == brute(data, lambda i: i % 10 == 0)


def test_large_scores(spark):
    data = [(0, [7e6, 7e6], 1), (1, [7e6, 7e6], 1), (2, [5e6, 5e6], 2), (3, [5e6, 6e6], 2), (4, [1.0, 1.0], 2)]
    assert mined(spark, data, "id = 0") == brute(data, lambda i: i == 0)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, [1e12], 1), (1, [1e12], 1)], "id = 0")


def test_few_and_none(spark):
    assert mined(spark, [], "id = 0") == []
    assert mined(spark, [(0, [1.0], 1)], "id = 0") == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 1)], "id = 0") == []
    assert mined(spark, [(0, [2.0], 1), (1, [2.0], 1), (2, [1.0], 0)], "id = 0") == [(0, 1, 1, 2, 512 * 512, 512 * 256)]
    assert mined(spark, [(0, [2.0], 1), (1, [2.0], 1), (2, [1.0], 0)], "id = 7") == []


def test_stream_holds_counters_only():
    """A third of all rows under one anchor: the pass takes keys one by one."""
    window = hn.Window()
    keys = [hn.pack(0, 100, 0, 7)] + [hn.pack(0, 80, 1, i) for i in range(10_000)] + [hn.pack(1, 50, 1, 3)]
    taken = 0

    def feed():
        nonlocal taken
        for key in sorted(keys):
            taken += 1
            yield key

    stream = hn.stream_negatives(feed(), window, 5, 10)
    assert next(stream) == (0, 7, 1, 0, 100, 80) and taken == 2
    assert [r[2] for r in stream] == list(range(2, 11))


@pytest.mark.parametrize("row", [(0, 0, 0, 0), (5, -(2**63), 1, 2**63 - 1), (9, 2**63 - 1, 0, -(2**63))])
def test_keys_round_trip(row):
    assert hn.unpack(hn.pack(*row)) == row
