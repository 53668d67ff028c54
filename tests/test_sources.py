import gzip
import json

import pytest
from pyspark.sql import functions as F

from gleaner.functions.display import flat_map
from gleaner.operators.dense import hashing_embedder
from gleaner.plans.build import build_corpus, product_documents
from gleaner.plans.search import grounded_prompts, hybrid_hits, search, with_chunk_columns
from gleaner.plans.sizing import spread_scan
from gleaner.session import work_dir
from gleaner.sources import index_store, readers, writers

META = [
    {
        "parent_asin": "B1",
        "main_category": "Audio",
        "title": "Noise cancelling headphones",
        "features": ["light", "foldable"],
        "description": ["Wireless headphones with long battery life."],
        "details": {"Brand": "Hush", "Best Sellers Rank": {"Electronics": 7}},
        "average_rating": 4.5,
        "store": "Hush",
    },
    {"parent_asin": "B2", "title": "Left handed gaming mouse", "features": [], "average_rating": 3.9},
]
REVIEWS = [
    {"parent_asin": "B1", "title": "Very quiet", "helpful_vote": 4, "text": "long"},
    {"parent_asin": "B1", "title": "Great sound", "helpful_vote": 9},
    {"parent_asin": "B1", "title": "Broke", "helpful_vote": 0},
    {"title": "orphan", "helpful_vote": 1},
]


@pytest.fixture
def raw(tmp_path):
    def put(name, records, extra=""):
        with gzip.open(tmp_path / name, "wt") as out:
            out.write("\n".join(json.dumps(r) for r in records) + extra)

    put("meta_Audio.jsonl.gz", META, '\n{"parent_asin": "B9", broken')
    put("Audio.jsonl.gz", REVIEWS)
    put("Mice.jsonl.gz", REVIEWS[:1])
    return tmp_path


def test_meta_with_nested_details_and_a_bad_line(spark, raw, rows):
    path = str(raw / "meta_Audio.jsonl.gz")
    meta = readers.read_meta(spark, path)
    assert meta.count() == 3 and meta.where("parent_asin is null").count() == 1
    text = meta.where("parent_asin = 'B1'").select(flat_map(F.col("details"))).first()[0]
    assert text == 'Brand Best Sellers Rank Hush {"Electronics":7}'
    assert readers.read_meta(spark, path, malformed="drop").count() == 2
    kept = readers.read_meta(spark, path, ["parent_asin"], "keep")
    assert rows(kept) == [("B1", None), ("B2", None), (None, '{"parent_asin": "B9", broken')]
    with pytest.raises(ValueError):
        readers.read_meta(spark, path, malformed="guess")


def test_a_wrong_type_costs_one_value(spark, tmp_path, rows):
    path = tmp_path / "r.json"
    path.write_text('{"parent_asin": "B1", "title": "t", "helpful_vote": "many"}\n')
    assert rows(readers.read_reviews(spark, str(path))) == [("B1", "t", None)]


def test_categories(spark, raw, rows):
    assert readers.category_files("r/", ["A"], reviews=False) == {"meta": ["r/meta_A.jsonl.gz"]}
    sides = readers.read_category(spark, str(raw), ["Audio", "Mice"], meta=False)
    assert list(sides) == ["reviews"]
    assert rows(sides["reviews"].groupBy("subset").count()) == [("Audio", 4), ("Mice", 1)]
    assert rows(readers.read_category(spark, str(raw), ["Audio"])["meta"].groupBy("subset").count()) == [("Audio", 3)]


def test_reviews_scan_parses_three_columns(spark, raw):
    plan = readers.read_reviews(spark, str(raw / "Audio.jsonl.gz"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<parent_asin:string,title:string,helpful_vote:bigint,_bad_record:string>" in plan


@pytest.mark.parametrize("mode", ["null", "drop", "keep"])
def test_spread_lines_parse_alike(spark, tmp_path, rows, mode):
    lines = ['{"parent_asin":"a","title":"t","helpful_vote":3}', "", '{"parent_asin":"b","title":', "null", "[1]",
             '{"parent_asin":"c","helpful_vote":"x"}', '{"parent_asin":"d","title":{"k":1}}', "  "]
    path = tmp_path / "lines.jsonl"
    path.write_text("\n".join(lines))
    plain = readers.read_reviews(spark, str(path), malformed=mode)
    dealt = readers.read_reviews(spark, str(path), malformed=mode, spread=3)
    whole = "parent_asin is not null"
    assert rows(dealt.where(whole)) == rows(plain.where(whole))
    assert dealt.columns == plain.columns


def test_documents_from_files_spread(spark, raw, rows):
    paths = str(raw / "meta_Audio.jsonl.gz"), str(raw / "Audio.jsonl.gz")
    assert rows(product_documents(spark, *paths, spread=4)) == rows(product_documents(spark, *paths))


def test_documents_from_files(spark, raw):
    docs = product_documents(spark, str(raw / "meta_Audio.jsonl.gz"), str(raw / "Audio.jsonl.gz"), 2)
    got = {r["parent_asin"]: r["document"] for r in docs.collect()}
    assert got == {
        "B1": "Audio Noise cancelling headphones light foldable Wireless headphones with long battery life. "
        'Brand Best Sellers Rank Hush {"Electronics":7} Great sound | Very quiet',
        "B2": "Left handed gaming mouse ",
    }


@pytest.mark.parametrize("shared", [True, False])
def test_corpus_from_documents_to_prompt(spark, raw, tmp_path, shared):
    docs = product_documents(spark, str(raw / "meta_Audio.jsonl.gz"), str(raw / "Audio.jsonl.gz"))
    corpus = build_corpus(spark, docs, str(tmp_path / "index"), hashing_embedder(), shared_chunks=shared)
    asked = readers.single_query(spark, "gaming mouse")
    assert search(asked, corpus, "bm25").first()["chunk_id"] == "B2#000000"
    for mode in ("semantic", "hybrid"):
        assert search(asked, corpus, mode).orderBy("rank").first()["chunk_id"] == "B2#000000"
    with pytest.raises(ValueError):
        search(asked, corpus, "guess")
    by_text = hybrid_hits(asked, corpus, by_text=True)
    assert with_chunk_columns(by_text, corpus.chunks, ["product_title"], asked, 5).count() == by_text.count()
    prompt = grounded_prompts(asked, corpus).first()["prompt"]
    assert "Product ASIN: B2\nTitle: Left handed gaming mouse\nAverage Rating: 3.9\n" in prompt
    assert prompt.endswith("question:\ngaming mouse")


def test_queries_csv_and_single_query(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('queries\nplain query\n"quoted, with ""marks"" and\na break"\n')
    got = [tuple(r) for r in readers.read_queries(spark, str(path)).orderBy("query_id").collect()]
    assert got == [(0, "plain query"), (1, 'quoted, with "marks" and\na break')]
    assert readers.single_query(spark, "one").collect() == [(0, "one")]


def test_column_list(spark, tmp_path):
    path = tmp_path / "columns.txt"
    path.write_text("main_category \n\n  title\n\t\n")
    assert readers.read_column_list(spark, str(path)) == ["main_category", "title"]


def test_csv_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(2, 'b "x"\n,'), (1, "a\\n")], "k int, answer string")
    writers.write_csv(df, str(tmp_path / "plain"))
    assert rows(writers.read_csv(spark, str(tmp_path / "plain"), df.schema)) == rows(df)
    numbered = writers.with_row_index(df.repartition(3), ["k"])
    assert rows(numbered) == [(0, 1, "a\\n"), (1, 2, 'b "x"\n,')]


def test_build_runs_once_unless_rewritten(spark, tmp_path):
    built = []

    def build(folder):
        built.append(folder)
        spark.range(3).write.parquet(f"{folder}/data")

    root = str(tmp_path / "index")
    assert index_store.latest_build(spark, root) is None
    first = index_store.build_if_absent(spark, root, build)
    assert index_store.build_if_absent(spark, root, build) == first and len(built) == 1
    second = index_store.build_if_absent(spark, root, build, rewrite=True)
    assert second != first and index_store.latest_build(spark, root) == second


def test_a_failed_build_leaves_the_earlier_one(spark, tmp_path):
    root = str(tmp_path / "index")
    good = index_store.build_if_absent(spark, root, lambda f: spark.range(1).write.parquet(f"{f}/data"))

    def fail(folder):
        spark.range(1).write.parquet(f"{folder}/data")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        index_store.build_if_absent(spark, root, fail, rewrite=True)
    assert index_store.latest_build(spark, root) == good


def test_work_dir_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        assert work_dir(spark).startswith(f"{shared.rstrip('/')}/")
    assert work_dir(spark) != work_dir(spark)


def test_scans_of_few_splits_are_spread(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert spread_scan(one).rdd.getNumPartitions() == 8
    many = spark.range(0, 100, 1, 64)
    assert spread_scan(many) is many
