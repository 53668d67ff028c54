"""Benchmark leaks: exact, renamed, renumbered and inconsistent copies, and edge cases."""

import random
import time

import pytest

from gleaner.llm import decontaminate

ITEM = (
    "Alice buys 12 apples and 7 pears, then Alice gives 3 apples to Bob who walks 5 km to the old market "
    "and sells them for twice the price"
)


def docs(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, h string, size int")


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_kinds_of_words():
    assert decontaminate.classify("12,5%")[0] == decontaminate.NUM
    assert decontaminate.classify("(Alice),") == (decontaminate.NAME, "alice")
    assert decontaminate.classify("5km")[0] == decontaminate.NUM_UNIT
    assert decontaminate.classify("km.") == (decontaminate.UNIT, "km")
    assert decontaminate.classify("%%%") == (decontaminate.LITERAL, "%%%")


def test_most_words_are_classified_by_column(monkeypatch):
    import pyarrow as pa

    words = ["Alice,", "(km)", "km.", "%%%", "plain", "(Zoë)", "5km", "12,5%", "x\x7fy", "don't", "A", "[[a]]", "ªb", "$5", "''"]
    expected = [decontaminate.classify(w) for w in words]
    kind, core = decontaminate.classify_all(pa.array(words))
    assert list(zip(kind.tolist(), core.to_pylist())) == expected
    one_by_one, asked = decontaminate.classify, []
    monkeypatch.setattr(decontaminate, "classify", lambda w: asked.append(w) or one_by_one(w))
    decontaminate.Templates(pa.array([" ".join(words)]))
    assert sorted(asked) == sorted(["(Zoë)", "5km", "12,5%", "x\x7fy", "ªb", "$5"])


def test_slots(spark, rows):
    renamed = ITEM.replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "40").replace("7", "9")
    mixed = ITEM.replace("Alice gives", "Zed gives").replace("Alice buys", "Carol buys")  # one name becomes two
    data = [
        (1, "before this. " + ITEM + " and after."),
        (2, "some other start " + renamed),
        (3, mixed),
        (4, ITEM.lower().replace("apples", "stones").replace("market", "harbour").replace("sells", "throws")),
        (5, None),
        (6, ""),
        (None, ITEM),
        (7, "unrelated words only " * 2000 + ITEM),
        (1, "before this. " + ITEM + " and after."),
    ]
    found = decontaminate.leaks(docs(spark, data), items(spark, [(10, ITEM), (11, None), (None, ITEM), (12, "too short")]))
    got = rows(found, "doc_id", "item_id", "exact")
    assert got == [(1, 10, True), (2, 10, False), (7, 10, True)]
    kept = rows(decontaminate.clean(docs(spark, data), items(spark, [(10, ITEM)])), "doc_id")
    assert kept == sorted([(3,), (4,), (5,), (6,), (None,)], key=repr)


def test_short_items_and_empty_tables(spark, rows):
    data = docs(spark, [(1, "we say that five words are few enough here"), (2, "five words are enough")])
    short = items(spark, [(1, "five words are few enough")])
    assert rows(decontaminate.leaks(data, short), "doc_id") == [(1,)]
    assert decontaminate.leaks(data, items(spark, [])).count() == 0
    assert decontaminate.leaks(data.limit(0), short).count() == 0


def test_equals_plain_search(spark, rows):
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    bench = [(i, text(rng.randrange(9, 40))) for i in range(20)]
    data, expected = [], set()
    for i in range(200):
        held = rng.sample(bench, rng.choice([0, 0, 1, 2]))
        parts = [text(rng.randrange(0, 60))]
        for item, words in held:
            parts += [words, text(rng.randrange(0, 60))]
            expected.add((i, item))
        data.append((i, "\n".join(parts)))
    found = decontaminate.leaks(docs(spark, data), items(spark, bench))
    assert rows(found, "doc_id", "item_id") == sorted(expected, key=repr)
    assert found.where("share < 1 or not exact").count() == 0


@pytest.mark.parametrize("size", [5, 8])
def test_windows_do_not_cross_texts(size):
    import pyarrow as pa

    first, _ = decontaminate.Templates(pa.array(["a b c d e f g h", "i j", None, "k l m n o p q r s"])).windows(size)
    assert len(first) == (8 - size + 1) + (9 - size + 1)


def test_long_edited_and_contradicting_copies(spark, rows):
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(5000)}x" for _ in range(n)]
    long, edited, numbers, renamed = text(1000), text(100), text(100), text(100)
    numbers[20] = numbers[70] = "2"
    renamed[20] = renamed[70] = "Alice"
    bench = items(spark, [(1, " ".join(long)), (2, " ".join(edited)), (3, " ".join(numbers)), (4, " ".join(renamed))])
    inserted = " new ".join(" ".join(edited[i : i + 20]) for i in range(0, 100, 20))
    broken, other = [*numbers], [*renamed]
    broken[70] = "5"
    other[20], other[70] = "Carol", "Zed"
    data = [(1, " ".join(long[300:500])), (2, inserted), (3, " ".join(broken)), (4, " ".join(other))]
    data += [(5, " ".join(long[300:345])), (6, " ".join(w for i in range(0, 1000, 100) for w in [*long[i : i + 12], "off"]))]
    found = decontaminate.leaks(docs(spark, data), bench)
    assert rows(found, "doc_id", "item_id", "exact") == [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True)]
    share = {r["doc_id"]: r["share"] for r in found.collect()}
    assert share[1] == pytest.approx(193 / 993) and share[2] == pytest.approx(65 / 93)


def test_dense_slots_other_case_and_short_items(spark, rows):
    title = "Der Kleine Prinz Und Die Rose Auf Dem Fernen Planeten Im All"
    drill = "What is 345 times 27 minus 18?"
    long = "Then Anna paid 5 and Bernd paid 7 and Carla paid 9 for 3 Pizzas"
    listed = "Alice Bob Carol 12 13 14 15 16 17"
    bench = items(spark, [(1, drill), (2, title), (3, "four words only here"), (4, long), (5, listed), (6, "Bonjour!"), (7, "")])
    data = [
        (1, "so now tell me: What is 512 times 43 minus 99? It is not hard."),
        (2, "we read DER KLEINE PRINZ UND DIE ROSE AUF DEM FERNEN PLANETEN IM ALL yesterday"),
        (3, "we read der kleine prinz und die rose auf dem fernen planeten im all yesterday"),
        (4, "there are Four Words, only here."),
        (5, "it went on. Then Dora paid 50 and Emil paid 70 and Frida paid 90 for 30 Cakes"),
        (6, "it went on. Then Dora paid 50 and Dora paid 70 and Frida paid 90 for 30 Cakes"),
        (7, "a table: Xaver Yvonne Zoe 91 92 93 94 95 96 and so on"),
        (8, "a table: ALICE BOB CAROL 12 13 14 15 16 17 and so on"),
        (9, "What is 512 times 512 minus 99?"),
        (10, "What is 345 times 27 plus 18?"),
        (11, "He said bonjour and left"),
        (12, "only four words here"),
    ]
    found = rows(decontaminate.leaks(docs(spark, data), bench), "doc_id", "item_id", "exact")
    expected = [(1, 1, False), (2, 2, True), (3, 2, True), (4, 3, True), (5, 4, False), (8, 5, True), (11, 6, True)]
    assert found == sorted(expected, key=repr)


def test_edges_of_very_long_words_are_stripped_in_one_pass():
    started = time.monotonic()
    assert decontaminate.classify("a" + "-" * 200_000 + "a")[0] == decontaminate.LITERAL
    assert decontaminate.classify("-" * 200_000 + "b" + "-" * 200_000) == (decontaminate.LITERAL, "b")
    assert decontaminate.classify("-" * 200_000)[1] == "-" * 200_000
    assert time.monotonic() - started < 1
