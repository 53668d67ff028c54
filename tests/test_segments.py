"""Segmented index: pruned search and statistics against a plain index over what is live."""

import math
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleaner.operators import block_max, lexical
from gleaner.session import work_dir
from gleaner.sources import segments as sg

WORDS = [f"w{i}" for i in range(40)]
SCHEMA = "chunk_id string, k string, text string"


def chunks_of(dice, keys, most=3):
    """Chunks whose words thin out, as those of real texts do."""
    out = []
    for key in keys:
        for n in range(dice.randint(1, most)):
            words = [WORDS[min(int(dice.expovariate(0.12)), 39)] for _ in range(dice.randint(0, 30))]
            out.append((f"{key}#{n}", key, " ".join(words)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(live, queries, k):
    """Plain BM25 in Python."""
    tokens = {c: text.split() for c, _, text in live}
    n = len(tokens)
    avgdl = sum(map(len, tokens.values())) / n
    df = Counter(w for words in tokens.values() for w in set(words))
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {w: v if v >= 0 else 0.25 * mean for w, v in raw.items()}
    out = []
    for q, text in queries:
        scores = {}
        for c, words in tokens.items():
            tf = Counter(words)
            hit = [w for w in text.split() if w in tf]
            if hit:
                scores[c] = sum(idf[w] * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(words) / avgdl)) for w in hit)
        best = sorted(scores, key=lambda c: (-round(scores[c], 9), c))[:k]
        out += [(q, rank + 1, c, round(scores[c], 6)) for rank, c in enumerate(best)]
    return sorted(out)


QUERIES = [(1, "w0 w1 w30"), (2, "w39 w38 w2 w2"), (3, "none"), (4, ""), (5, "w0"), (6, " ".join(WORDS))]


def hits(spark, index, k=4):
    asked = spark.createDataFrame(QUERIES, "query_id long, query string")
    found = block_max.pruned_search(asked, index.block_index(), k)
    return sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["score"], 6)) for r in found.collect())


def files(root, segment):
    return sorted((str(p), p.stat().st_mtime_ns) for p in Path(root).rglob("*") if f"segment={segment}" in str(p))


def test_drops_replace_delete_and_compact(spark):
    dice, root, live = random.Random(7), work_dir(spark), {}
    first = None
    for drop in range(4):
        rows = chunks_of(dice, [f"p{i}" for i in dice.sample(range(60), 40 if drop == 0 else 15)])
        deleted = [f"p{i}" for i in dice.sample(range(60), 3)] if drop else []
        deleted = [d for d in deleted if d not in {k for _, k, _ in rows}]
        touched = spark.createDataFrame([(d,) for d in deleted], "k string")
        index = sg.add_segment(spark, root, frame(spark, rows), touched, "k", shards=3)
        for key in {k for _, k, _ in rows} | set(deleted):
            live.pop(key, None)
        for row in rows:
            live.setdefault(row[1], []).append(row)
        now = [r for rows in live.values() for r in rows]
        assert sorted(r["chunk_id"] for r in index.chunks().collect()) == sorted(c for c, _, _ in now)
        assert hits(spark, index) == brute(now, QUERIES, 4)
        if first is None:
            first = files(root, index.segments[0])
    # earlier segments are as they were
    assert first == files(root, index.segments[0]) and len(index.segments) == 4
    df = Counter(w for _, _, text in now for w in set(text.split()))
    assert {r["term"]: r["df"] for r in index.terms().collect()} == dict(df)
    assert index.dead_rows == index.dead().count() > 0

    merged = sg.compact(index, index.segments[1:3])
    assert len(merged.segments) == 3 and merged.segments[0] == index.segments[0]
    assert hits(spark, merged) == brute(now, QUERIES, 4) and first == files(root, index.segments[0])
    whole = sg.compact(merged)
    assert len(whole.segments) == 1 and whole.dead_rows == 0
    assert hits(spark, whole) == brute(now, QUERIES, 4)

    # a session whose catalogue does not know the table, and what a failed commit leaves behind
    name = sg._blocks_table(spark, root, 3, "string")
    spark.sql(f"DROP TABLE {name}")
    stray = frame(spark, [("x#0", "x", "w0 w0 w0")])
    sg.write_parquet(stray, f"{root}/chunks/segment=stray")
    sg._write_blocks(block_max.cut_blocks(lexical.build_postings(stray), 3, 1.0), root, "stray", 3, "string")
    again = sg.open_segments(spark, root)
    assert again.version == 6 and hits(spark, again) == brute(now, QUERIES, 4)


def test_too_many_dead_chunks_are_merged_away(spark):
    root, dice = work_dir(spark), random.Random(1)
    rows = chunks_of(dice, [f"p{i}" for i in range(10)])
    sg.add_segment(spark, root, frame(spark, rows), key="k", shards=2, most_dead=5)
    index = sg.add_segment(spark, root, frame(spark, rows), key="k", shards=2, most_dead=5)
    assert len(index.segments) == 1 and index.dead_rows == 0 and index.n == len(rows)
    assert hits(spark, index) == brute(rows, QUERIES, 4)


def test_null_keys_and_empty_drops(spark):
    root = work_dir(spark)
    assert sg.open_segments(spark, root) is None
    index = sg.add_segment(spark, root, frame(spark, [("a", None, "w1"), ("b", "p", None)]), key="k", shards=2)
    index = sg.add_segment(spark, root, frame(spark, [("c", None, "w2 w1")]), key="k")
    index = sg.add_segment(spark, root, frame(spark, []), key="k")
    assert sorted(r["chunk_id"] for r in index.chunks().collect()) == ["a", "b", "c"] and index.n == 3
    assert hits(spark, index) == brute([("a", None, "w1"), ("b", "p", ""), ("c", None, "w2 w1")], QUERIES, 4)


def test_negative_weights_are_not_pruned(spark):
    root = work_dir(spark)
    rows = [(f"c{i}", f"p{i}", "w0 " * (i % 3 + 1) + "w1 " * (i % 2)) for i in range(9)]
    index = sg.add_segment(spark, root, frame(spark, rows), key="k", shards=2)
    assert index.avg_idf < 0
    assert hits(spark, index) == brute(rows, QUERIES, 4)


@pytest.fixture(scope="module")
def zipf(spark):
    dice = random.Random(3)
    rows = chunks_of(dice, [f"p{i}" for i in range(1500)], 1)
    return rows, sg.add_segment(spark, work_dir(spark), frame(spark, rows), key="k", shards=2)


def test_blocks_are_skipped(spark, zipf):
    rows, index = zipf
    asked = spark.createDataFrame([(1, "w30 w0"), (2, "w25 w1 w2")], "query_id long, query string")
    share = block_max.pruned_share(asked, index.block_index(), 3).collect()
    every = Counter(w for _, _, text in rows for w in set(text.split()))
    assert {r["query_id"]: r["postings"] for r in share} == {1: every["w30"] + every["w0"], 2: every["w25"] + every["w1"] + every["w2"]}
    assert sum(r["scored"] for r in share) < 0.5 * sum(r["postings"] for r in share)


def test_postings_are_not_shuffled(spark, zipf):
    _, index = zipf
    asked = spark.createDataFrame([(1, "w30 w0")], "query_id long, query string")
    blocks, wanted = block_max._asked(lexical.query_terms(asked), index.block_index())
    scores = block_max._scores(blocks, wanted, index.block_index())
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan and "In(term" in plan
    assert scores.agg(F.count(F.lit(1))).first()[0] > 0


def test_shards_follow_the_postings_of_the_first_drop(spark, monkeypatch):
    monkeypatch.setattr(sg, "SHARDS", 2)
    monkeypatch.setattr(sg, "SHARD_POSTINGS", 10)
    root, dice = work_dir(spark), random.Random(3)
    rows = chunks_of(dice, [f"p{i}" for i in range(20)])
    postings = sum(len(set((text or "").split())) for _, _, text in rows)
    index = sg.add_segment(spark, root, frame(spark, rows), key="k")
    assert index.shards == -(-postings // 10) > 2
    later = sg.add_segment(spark, root, frame(spark, rows[:3]), key="k")
    assert later.shards == index.shards


@pytest.mark.parametrize("shards", [1, 16, 60])
def test_every_shard_has_a_partition_of_its_own(spark, shards):
    """Else some tasks sort and score several shards while others have none."""
    rows = spark.range(shards * 40).select(
        F.col("id").alias("chunk_id"), F.lit(1).alias("dl"), F.lit("w").alias("term"), F.lit(1).alias("tf")
    )
    blocks = block_max.cut_blocks(rows, shards, 1.0).select("shard", F.spark_partition_id().alias("part"), "size").collect()
    assert len({b["shard"] for b in blocks}) == len({b["part"] for b in blocks}) == shards
    assert sum(b["size"] for b in blocks) == shards * 40


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_blocks_go_on_over_batches(spark, monkeypatch, batch):
    """Blocks of four: the strongest postings first, whatever rows come at a time."""
    dice = random.Random(batch)
    rows = [
        (f"c{c}", dl, term, dice.randint(1, 3)) for c in range(40) for dl in [dice.randint(1, 5)] for term in "abc" if dice.random() < 0.6
    ]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        postings = spark.createDataFrame(rows, "chunk_id string, dl int, term string, tf int")
        blocks = block_max.cut_blocks(postings, 2, 3.0, size=4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    listed, held = {}, []
    for b in sorted(blocks, key=lambda b: (b["shard"], b["term"], b["block"])):
        own = [tuple(p) for p in b["postings"]]
        assert b["size"] == len(own) <= 4 and b["max_tf"] == max(p[1] for p in own) and b["min_dl"] == min(p[2] for p in own)
        run = listed.setdefault((b["shard"], b["term"]), [])
        assert b["block"] * 4 == len(run)
        run += own
        held += [(c, dl, b["term"], tf) for c, tf, dl in own]
    assert sorted(held) == sorted(rows)
    for run in listed.values():
        assert run == sorted(run, key=lambda p: (-p[1] / (p[1] + 1.5 * (0.25 + 0.75 * p[2] / 3.0)), p[0]))


def test_candidates_beyond_a_broadcast_are_scored_in_place(spark, zipf, monkeypatch):
    rows, index = zipf
    before = hits(spark, index)
    monkeypatch.setattr(block_max, "MOST_CANDIDATES", 0)
    assert hits(spark, index) == before == brute(rows, QUERIES, 4)
    found = block_max.pruned_search(spark.createDataFrame(QUERIES, "query_id long, query string"), index.block_index(), 4)
    scored = found._jdf.queryExecution().executedPlan().toString()
    # nothing but the first rows of each query and task is shuffled
    assert scored.count("Exchange hashpartitioning") == scored.count("Exchange hashpartitioning(query_id")
    share = block_max.pruned_share(spark.createDataFrame(QUERIES, "query_id long, query string"), index.block_index(), 4).collect()
    assert all(r["scored"] >= r["postings"] for r in share)


ODD = [("a", None, "w1 w1 w2"), ("a", None, "w1 w3"), (None, "p", "w2 \u00a0w2\x1cw9 "), ("b", "p", None), ("c", "p", " "), ("d", "q", "")]


def test_bags_hold_the_postings_of_odd_rows(spark):
    rows = frame(spark, ODD + chunks_of(random.Random(5), [f"p{i}" for i in range(300)]))
    bags, postings = lexical.build_bags(rows), lexical.build_postings(rows)
    opened = bags.select("chunk_id", "dl", F.inline(F.arrays_zip("terms", "tfs")))
    assert bags.count() == rows.count()
    assert sorted(map(repr, opened.collect())) == sorted(
        repr(r).replace("term=", "terms=").replace("tf=", "tfs=") for r in postings.collect()
    )
    plain = block_max.cut_blocks(postings, 3, 9.0, size=4)
    cut = block_max.cut_bags(bags, 3, 9.0, size=4)
    assert sum(b["tokens"] for b in cut.collect()) == sum(p["tf"] for p in postings.collect())
    columns = ["shard", "term", "block", "size", "max_tf", "min_dl", "tokens"]
    assert sorted(cut.select(columns).collect()) == sorted(plain.select(columns).collect())
    # a row a chunk is shuffled, none a posting is sorted
    steps = cut._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in steps and "Generate" not in steps


def test_a_shard_gives_its_best_only(spark, zipf):
    _, index = zipf
    asked = lexical.query_terms(spark.createDataFrame([(1, "w30 w0"), (2, "w1")], "query_id long, query string"))
    blocks, wanted = block_max._asked(asked, index.block_index())
    assert block_max._scores(blocks, wanted, index.block_index(), 3).count() == 2 * 3 * index.shards


@pytest.mark.parametrize("most", [(1, 1, 0), (4_000_000, 64, 1e9)])
def test_scores_by_strips_and_by_matrices(spark, zipf, monkeypatch, most):
    """A query at a time, each product by its place; and all terms as matrices."""
    rows, index = zipf
    for name, value in zip(("STRIP_SCORES", "STRIP_TERMS", "DENSE"), most, strict=True):
        monkeypatch.setattr(block_max, name, value)
    assert hits(spark, index) == brute(rows, QUERIES, 4)


def test_an_id_that_repeats_is_scored_with_all_its_postings(spark):
    """Its score may be above what one posting of each term can give."""
    rows = [(f"c{i}", f"p{i}", "w0 w1 " + "w2 " * 5) for i in range(300)] + [("z", f"z{i}", "w0 w5") for i in range(4)]
    rows += [(f"d{i}", f"d{i}", "w3") for i in range(800)]
    index = sg.add_segment(spark, work_dir(spark), frame(spark, rows), key="k", shards=1)
    asked = spark.createDataFrame([(1, "w0 w1")], "query_id long, query string")
    every = sum(r["tf"] for r in lexical.build_postings(frame(spark, rows)).where("chunk_id = 'z' and term = 'w0'").collect())
    first = block_max.pruned_search(asked, index.block_index(), 1).first()
    assert every == 4 and first["chunk_id"] == "z"


def test_dead_chunks_are_carried_as_long_as_they_are_few_beside_the_live(spark):
    """Merging costs as much as the whole index: a large index is not merged at every drop."""
    root = work_dir(spark)
    rows = [(f"p{i}#0", f"p{i}", f"w{i % 7} w{i % 5}") for i in range(60)]
    sg.add_segment(spark, root, frame(spark, rows), key="k", shards=2, most_dead=5)
    index = sg.add_segment(spark, root, frame(spark, rows[:10]), key="k", most_dead=5)
    assert len(index.segments) == 2 and index.dead_rows == 10
    assert hits(spark, index) == brute(rows, QUERIES, 4)
