from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gleaner.functions.text import tokenise_lower
from gleaner.operators.proximity import build_positions, pool_positions, query_pairs, with_proximity

CHUNKS = "chunk_id long, text string"
QUERIES = "query_id long, query string"


def by_hand(query, text):
    """Proximity and phrases by trying all pairs of places."""
    asked, held = query.split(), (text or "").split()
    pairs = [(a, b) for a, b in zip(asked, asked[1:]) if a != b]
    near = side = 0.0
    for a, b in pairs:
        gaps = [j - i for i, x in enumerate(held) for j, y in enumerate(held) if (x, y) == (a, b)]
        if gaps:
            near += 1 / min(abs(g) for g in gaps) ** 2
            side += 1 in gaps
    return (round(near / len(pairs), 9), round(side / len(pairs), 9)) if pairs else (0.0, 0.0)


def test_positions_of_each_term(spark, rows):
    chunks = spark.createDataFrame([(1, "b a  b\nc"), (2, ""), (3, None), (4, "B b")], CHUNKS)
    assert rows(build_positions(chunks)) == [
        (1, "a", [1]), (1, "b", [0, 2]), (1, "c", [3]), (4, "B", [0]), (4, "b", [1]),
    ]
    assert rows(build_positions(chunks.where("chunk_id = 4"), tokenise_lower)) == [(4, "b", [0, 1])]


def test_pairs_of_a_query(spark, rows):
    queries = spark.createDataFrame([(1, "a b a b b"), (2, "a"), (3, ""), (4, None), (5, "a a")], QUERIES)
    assert rows(query_pairs(queries)) == [(1, "a", "b", 2), (1, "b", "a", 1)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=12), min_size=2, max_size=5),
       st.lists(st.lists(st.sampled_from("abcde"), max_size=6), min_size=1, max_size=3))
def test_scores_equal_all_places_by_hand(spark, texts, asked):
    chunks = [(i, " ".join(words)) for i, words in enumerate(texts)] + [(99, None)]
    queries = [(i, " ".join(words)) for i, words in enumerate(asked)]
    pool = spark.createDataFrame(
        [(q, c, 1.0) for q, _ in queries for c, _ in chunks] + [(0, 1000, 1.0)], "query_id long, chunk_id long, rrf double"
    )
    table = spark.createDataFrame(chunks, CHUNKS)
    scored = with_proximity(pool, spark.createDataFrame(queries, QUERIES), pool_positions(pool, table)).collect()
    got = {(r.query_id, r.chunk_id): (round(r.proximity, 9), round(r.phrases, 9)) for r in scored}
    want = {(q, c): by_hand(query, text) for q, query in queries for c, text in chunks}
    assert got == want | {(0, 1000): (0.0, 0.0)} and len(scored) == len(got)


def test_long_chunks_and_empty_tables(spark, rows):
    long = " ".join(["a"] * 50_000 + ["b"])
    pool = spark.createDataFrame([(1, 1)], "query_id long, chunk_id long")
    queries, chunks = spark.createDataFrame([(1, "a b")], QUERIES), spark.createDataFrame([(1, long)], CHUNKS)
    assert rows(with_proximity(pool, queries, build_positions(chunks))) == [(1, 1, 1.0, 1.0)]
    assert rows(with_proximity(pool, queries, build_positions(chunks.limit(0)))) == [(1, 1, 0.0, 0.0)]
    assert rows(with_proximity(pool.limit(0), queries, build_positions(chunks))) == []
