"""Judge URLs by host rules and by logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 13
MAX_LABELLED = 20_000
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# A small labelled URL table to train from when the caller has none.
BLOCKED = """
cheap-pills.example.com/buy  www.cheap-pills.org/en/12  pills-online.net/order  best-pills.shop/viagra
casino-win.example.net/play  blog.casino-win.com/en/4  m.casino-royal.net/slots  free-casino.org/bonus
free-bets.example.net/es/9  free-bets.com/odds  bets-today.net/win  sport-bets.org/free
spam-farm.example.org/en/1  www.spam-farm.com/x  link-farm.net/a  seo-farm.org/backlinks
adult-x.example.com/en/7  adult-x.net/cam  adult-chat.org/live  xxx-adult.com/videos
ads-track.example.com/pixel  m.ads-track.net/click  track-ads.org/c  click-ads.com/track
win-prize.net/claim  free-prize.org/win  cheap-loans.com/now  fast-loans.net/cheap
""".split()
ALLOWED = """
www.example.com/about  example.org/en/671  library.example.org/books/12  news.example.net/2020/05/article
blog.example.com/en/853/  docs.example.net/guide/start  university.org/courses  museum.net/en/exhibits
m.weather.org/forecast  www.recipes.com/bread  history.net/en/448.html  science.org/journal/12
forum.example.org/thread/99  wiki.example.com/page  city.gov/services  school.org/calendar
garden.net/plants/rose  travel.com/guides/paris  music.org/scores/22  health.gov/advice
code.net/project/readme  books.com/en/364  art.org/gallery/9  maps.net/en/12  thther.example.org/en/685
tionble.example.com/en/12  theres.example.com/fr/4  therin.example.net/en/770  ththan.example.net/de/960
edand.example.org/es/3
""".split()


def example_urls(spark) -> DataFrame:
    """The labelled URLs above: url, blocked."""
    rows = [(f"http://{u}", True) for u in BLOCKED] + [(f"http://{u}", False) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, blocked boolean")


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL column; both empty without ``://`` or for null.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, the path what follows up to
    ``?``, ``#`` or the end.
    """
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, *LETTERS), path


def grams(text: Column, mark: str) -> Column:
    """Hash buckets of the character 3-, 4- and 5-grams of ``^text$``, repeats included."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(framed) - (n - 1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(mark), F.substr(framed, i, F.lit(n))), F.lit(BUCKETS)))

    return F.concat(of_length(3), of_length(4), of_length(5))


def features(host: Column, path: Column) -> Column:
    """Distinct buckets of host and path n-grams, as array positions from 1."""
    return F.transform(F.array_distinct(F.concat(grams(host, "h"), grams(path, "p"))), lambda b: (b + 1).cast("int"))


def constant(values: list[float]) -> Column:
    """A constant array of doubles, folded to one literal by the optimiser."""
    return F.from_json(F.lit(json.dumps(values)), "array<double>")


def margin(found: Column, model: list[float]) -> Column:
    """Bias plus the mean weight of the features, scaled by the root of their number; the bias comes first."""
    weights = constant(model[1:])
    total = F.aggregate(found, F.lit(0.0), lambda s, f: s + F.element_at(weights, f))
    return F.lit(model[0]) + total / F.sqrt(F.greatest(F.size(found), F.lit(1)))


def train(labelled: DataFrame, rounds: int = 40, rate: float = 16.0, decay: float = 1e-4) -> list[float]:
    """Logistic regression by full-batch gradient descent; a bias and one weight a bucket.

    ``labelled``: url, blocked.  It must be a small table (at most ``MAX_LABELLED`` rows, else an error); rows
    with a null label are left out.  Each round is one aggregation by bucket.  An empty table gives zero weights.
    """
    host, path = host_and_path("url")
    rows = labelled.where(F.col("blocked").isNotNull()).select(
        features(host, path).alias("f"), F.col("blocked").cast("double").alias("y")
    )
    rows = rows.cache()
    try:
        count = rows.count()
        if count > MAX_LABELLED:
            raise ValueError(f"more than {MAX_LABELLED} labelled rows")
        model = [0.0] * (BUCKETS + 1)
        for _ in range(rounds if count else 0):
            error = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(F.col("f"), model))) - F.col("y")
            scaled = rows.select("f", error.alias("e"), (error / F.sqrt(F.size("f"))).alias("s"))
            buckets = scaled.select(F.explode(F.concat(F.array(F.lit(0)), "f")).alias("b"), "e", "s")
            gradient = buckets.groupBy("b").agg(F.sum(F.when(F.col("b") == 0, F.col("e")).otherwise(F.col("s"))).alias("g"))
            model = [w * (1 - rate * decay) if i else w for i, w in enumerate(model)]
            for row in gradient.collect():  # at most one row a bucket
                model[row["b"]] -= rate * row["g"] / count
        return [round(w, 9) for w in model]
    finally:
        rows.unpersist()


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule ``host/path`` that fits, and its verdict; null where none does.

    A rule fits its host and all subdomains if the path starts with the rule's, which begins with the slash.  Of rules of equal length the
    first in the list wins.
    """
    fits = []
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        of_host, slash, of_path = rule.partition("/")
        same = (host == of_host) | F.endswith(host, F.lit(f".{of_host}"))
        fits.append((same & F.startswith(path, F.lit(slash + of_path)), rule, verdict))
    found, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for fit, rule, verdict in reversed(fits):
        found, said = F.when(fit, rule).otherwise(found), F.when(fit, verdict).otherwise(said)
    return found, said


def judge(pages: DataFrame, url: str, rules: list[tuple[str, str]], model: list[float]) -> DataFrame:
    """Add host, path, rule, blocked_score (0 to 1) and verdict (``allow`` or ``block``) to every row.

    A fitting rule decides; else the classifier blocks from a score of 0.5.  Null, empty and malformed URLs have
    an empty host and path and are judged by the classifier like others.  Columns of the same names are replaced.
    """
    host, path = host_and_path(url)
    parts = pages.withColumns({"host": host, "path": path})
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(features(F.col("host"), F.col("path")), model)))
    scored = parts.withColumns({"rule": rule, "verdict": said, "blocked_score": score})
    by_score = F.when(F.col("blocked_score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("verdict", by_score))
