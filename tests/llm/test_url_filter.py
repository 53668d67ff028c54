"""Host, path and rules by hand, the classifier against plain Python, and the plan without Python."""

import pytest

from gleaner.llm import queries, url_filter

URLS = [
    ("http://Thing.example.COM/en/1?x=/fr/#a", "thing.example.com", "/en/1", "example.com/en/", "block"),
    ("https://www.example.com/en/2", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
    ("https://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/2", "notexample.com", "/en/2", "com/", "allow"),
    ("http://x.com", "x.com", "", None, None),
    ("http://x.net/es/3", "x.net", "/es/3", "net/es/", "block"),
    ("http://x.net/es", "x.net", "/es", None, None),
    ("http://x.net?y=/es/", "x.net", "", None, None),
    ("no scheme/es/", "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("http://", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("http://ÄB.net/fr/\nq", "Äb.net", "/fr/\nq", "net/fr/", "block"),
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u[0], "keep") for i, u in enumerate(URLS)], "page_id long, url string, weights string")
    judged = url_filter.judge(df, "url", queries.RULES, [-1.0] + [0.0] * url_filter.BUCKETS).orderBy("page_id").collect()
    for row, (_, host, path, rule, verdict) in zip(judged, URLS, strict=True):
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or "allow") and row["weights"] == "keep"


def test_classifier_learns_the_table(spark):
    examples = url_filter.example_urls(spark)
    model = url_filter.train(examples)
    judged = url_filter.judge(examples, "url", [], model).collect()
    right = sum((r["verdict"] == "block") == r["blocked"] for r in judged)
    assert right >= 0.97 * len(judged)
    fresh = [("http://m.cheap-pills.example.org/x/1", True), ("http://blog.casino-win.example.org/q", True),
             ("https://www.thernd.example.org/en/334/", False), ("http://onther.example.net/de/12", False)]
    df = spark.createDataFrame(fresh, "url string, blocked boolean")
    assert all((r["verdict"] == "block") == r["blocked"] for r in url_filter.judge(df, "url", [], model).collect())


def test_margin_against_python(spark):
    model = [0.5] + [((i * 37) % 101 - 50) / 100 for i in range(url_filter.BUCKETS)]
    df = spark.createDataFrame([("http://ab.c/d",)], "url string")
    host, path = url_filter.host_and_path("url")
    row = df.select(url_filter.features(host, path).alias("f"), url_filter.margin(url_filter.features(host, path), model).alias("m")).first()
    assert len(row["f"]) == len(set(row["f"])) and len(row["f"]) <= 4 + 3 + 2 + 2 + 1 + 1
    assert row["m"] == pytest.approx(0.5 + sum(model[f] for f in row["f"]) / len(row["f"]) ** 0.5)


def test_empty_and_null_labels(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    assert set(url_filter.train(none)) == {0.0}
    unknown = spark.createDataFrame([("http://a.b", None)], "url string, blocked boolean")
    assert set(url_filter.train(unknown)) == {0.0}


def test_no_python_in_the_plan(spark):
    plan = queries.op2_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
