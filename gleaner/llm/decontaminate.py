"""Benchmark decontamination by template windows with a slot check."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import Bitmap, hash_strings, lean, mix64, powers, saved, slices, small_side

WINDOW = 8
LEAST_WORDS = 5  # of a template; shorter items are looked up by their words alone
LEAST_LITERALS = 3  # of an item whose windows are mostly placeholders
LEAST_SHARE = 0.25
LEAST_RUN = 50  # covered words of an item, in a stretch without a gap of a window, that are a leak at any share
CONTRADICTED_SHARE = 2 / 3  # asked of a copy whose slots contradict each other
BASE = 0x9E3779B97F4A7C15

NUMBER = regex.compile(r"[+\-]?[$€£]?\d[\d.,:/]*%?")
NUMBER_UNIT = regex.compile(r"([+\-]?[$€£]?\d[\d.,]*)(\p{L}+)")
HEAD = regex.compile(r"[\p{P}\p{S}]*")
TAIL = regex.compile(r"[\p{P}\p{S}]*\Z", regex.REVERSE)  # from the end backwards: one pass, however long the word
# Words that count as a unit after a number.
UNITS = frozenset(
    """mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer
    kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces
    ton tons ml l dl liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour
    hours day days week weeks month months year years hz khz mhz ghz w kw mw v a j kj cal kcal pa bar k c f
    degree degrees percent dollar dollars euro euros cent cents mph kph kmh kb mb gb tb""".split()
)
LITERAL, NUM, NAME, UNIT, NUM_UNIT = range(5)
PLAIN, TEMPLATE, SPARSE = range(3)
MARKS = {NUM: "\x00number", NAME: "\x00name", UNIT: "\x00unit", NUM_UNIT: "\x00number unit"}


def classify(word: str) -> tuple[int, str]:
    """Kind of a word by its form alone, and its text without punctuation at the edges, in lower case."""
    if NUMBER.fullmatch(word.strip(".,;:!?()[]\"'")):
        return NUM, word.strip(".,;:!?()[]\"'")
    core = word[HEAD.match(word).end() :]
    core = core[: TAIL.search(core).start()] or word
    joined = NUMBER_UNIT.fullmatch(core)
    if joined and joined[2].lower() in UNITS:
        return NUM_UNIT, core.lower()
    return (NAME if core[0].isupper() else UNIT if core.lower() in UNITS else LITERAL), core.lower()


def classify_all(distinct: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``classify`` for many words: ASCII ones without digits, nearly all of them, column by column.

    Such a word is no number, and all its characters but letters are punctuation or symbols.
    """
    plain = pc.match_substring_regex(distinct, r"^[!-/:-~]+$")
    easy = pc.filter(distinct, plain)
    core = pc.ascii_trim(easy, string.punctuation)
    core = pc.if_else(pc.equal(pc.binary_length(core), 0), easy, core)
    lower = pc.ascii_lower(core)
    unit = pc.is_in(lower, pa.array(sorted(UNITS), lower.type))
    kind = np.full(len(distinct), LITERAL)
    at = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
    kind[at[unit.to_numpy(zero_copy_only=False)]] = UNIT
    kind[at[pc.not_equal(pc.utf8_slice_codeunits(core, 0, 1), pc.utf8_slice_codeunits(lower, 0, 1)).to_numpy(zero_copy_only=False)]] = NAME
    others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
    found = [classify(w) for w in distinct.take(pa.array(others)).to_pylist()]
    kind[others] = [k for k, _ in found]
    cores = pa.concat_arrays([lower, pa.array([c for _, c in found], lower.type)])
    place = np.empty(len(distinct), np.int64)
    place[np.concatenate([at, others])] = np.arange(len(distinct))
    return kind, cores.take(pa.array(place))


class Templates:
    """The words of a batch of texts as templates: numbers, names and units are typed placeholders.

    A number has digits, a name begins with a capital, a unit is a listed word after a number (or is joined to
    it).  Kinds follow from the word and the one before it, so a passage has the same template anywhere.
    """

    def __init__(self, text: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
        flat, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
        real = pc.greater(pc.binary_length(flat), 0)
        coded = pc.filter(flat, real).dictionary_encode()
        self.row = pc.filter(rows, real).to_numpy().astype(np.int64)
        self.code = coded.indices.to_numpy().astype(np.int64)
        kind, self.core = classify_all(coded.dictionary)
        literal = hash_strings(self.core) if len(kind) else np.zeros(0, np.uint64)
        marks = hash_strings(pa.array(["", *(MARKS[k] for k in (NUM, NAME, UNIT, NUM_UNIT))]))
        self.kind, self.plain = kind[self.code], literal[self.code]
        after_number = np.zeros(len(self.row), bool)
        after_number[1:] = (self.kind[:-1] == NUM) & (self.row[1:] == self.row[:-1])
        self.kind[(self.kind == UNIT) & ~after_number] = LITERAL
        self.template = np.where(self.kind == LITERAL, self.plain, marks[self.kind])

    def windows(self, size: int, form: int = PLAIN) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of ``size`` words in one text that have the form, and their hashes.

        Every run is ``PLAIN``: hashed by its words without case.  As templates are hashed those with at least as
        many literal words as placeholders (``TEMPLATE``), and those with a quarter of literal words (``SPARSE``).
        """
        n = len(self.row)
        first = np.arange(max(0, n - size + 1))
        first = first[self.row[first] == self.row[first + size - 1]]
        if form != PLAIN:
            literal = np.concatenate([[0], np.cumsum(self.kind == LITERAL)])
            literal = literal[first + size] - literal[first]
            enough = 2 * literal >= size
            first = first[enough if form == TEMPLATE else ~enough & (4 * literal >= size)]
        values = self.plain if form == PLAIN else self.template
        power, back = powers(BASE, n + 1), powers(pow(BASE, -1, 1 << 64), n + 1)
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(values) * power[:n], dtype=np.uint64)])
        value = (total[first + size] - total[first]) * back[first]
        value = mix64(value + np.uint64(1)) if form == PLAIN else value
        return first, mix64(value + np.uint64(size)).view(np.int64)

    def slots(self, first: int, size: int) -> list[str]:
        """Kind and content of the placeholders of one run."""
        at = range(first, first + size)
        return [f"{self.kind[i]}{self.core[int(self.code[i])]}" for i in at if self.kind[i] != LITERAL]


def _windows(
    batches: Iterator[pa.RecordBatch], sizes: list[int], known: Bitmap | None
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "text"):
            key = piece.column("k")
            found = Templates(piece.column("text"))
            counts = np.bincount(found.row, minlength=piece.num_rows)
            literals = np.bincount(found.row, found.kind == LITERAL, minlength=piece.num_rows).astype(np.int64)
            start = np.cumsum(counts) - counts
            for size, form in ((s, f) for s in sizes for f in (PLAIN, TEMPLATE, SPARSE) if f == PLAIN or s >= LEAST_WORDS):
                first, value = found.windows(size, form)
                keep = np.arange(len(first)) if known is None else np.flatnonzero(known.hits(value))
                if known is None and size < WINDOW:
                    keep = keep[counts[found.row[first]] == size]
                if known is None and form == SPARSE:
                    keep = keep[literals[found.row[first[keep]]] >= LEAST_LITERALS]
                first, value = first[keep], value[keep]
                if len(first):
                    owner = found.row[first]
                    slots = [[] if form == PLAIN else found.slots(f, size) for f in first.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            key.take(pa.array(owner)),
                            pa.array(first - start[owner]),
                            pa.array(np.full(len(first), size)),
                            pa.array(np.full(len(first), form)),
                            pa.array(value),
                            pa.array(slots, pa.list_(pa.string())),
                            pa.array(counts[owner]),
                        ],
                        ["k", "at", "size", "form", "h", "slots", "n_words"],
                    )


SCHEMA = "k long, at long, size long, form long, h long, slots array<string>, n_words long"


def leaks(documents: DataFrame, benchmark: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds: doc_id, item_id, n_windows, share, exact.

    Every window of ``WINDOW`` words of an item is looked up in all windows of all documents; items with
    fewer words are one window, null and empty ones have none.  Windows are joined by their words without case
    and, from ``LEAST_WORDS`` words on, by their template.  Windows with more placeholders than literal words say
    little: they count where all windows of the item that have templates lie on one diagonal without
    contradiction, and the item has ``LEAST_LITERALS`` literal words.
    Windows that lie on one diagonal of a document and an item hold together: their slots must map one to one,
    so a renamed or renumbered item is found and a text that only shares the pattern is not.  Where slots
    contradict each other, the windows that hold them go, but those whose slots are all equal stay.  The windows
    of a pair's diagonals are added up, so that inserted or missing words do not hide a copy.  A pair is returned
    if the diagonals without contradiction cover ``least_share`` of the item's windows, if all diagonals cover
    ``CONTRADICTED_SHARE`` of them, or if they cover ``LEAST_RUN`` words of the item in a stretch without a gap of
    a window; ``exact`` tells that all slots of the covered windows are equal.
    Rows with a null id are left out on both sides; rows with the same id count as one document or item, and
    repeated rows once.

    The windows of the benchmark go into a bitmap of fixed size; document windows that it knows are joined with
    them exactly.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("k"), "text").where("k is not null").distinct()
    docs = documents.select(F.col("doc_id").cast("long").alias("k"), "text").where("k is not null")
    sizes = list(range(1, WINDOW + 1))
    asked = saved(items.mapInArrow(lean(lambda b: _windows(b, sizes, None)), SCHEMA))
    used = [r["size"] for r in asked.select("size").distinct().collect()]
    known = Bitmap(asked, "h")
    seen = docs.mapInArrow(lean(lambda b: _windows(b, sorted(used), known)), SCHEMA)
    # rows that share an id are one item, but each has its own number of windows
    whole = Window.partitionBy("k", "size", "n_words")
    asked = asked.withColumn("n_templates", F.size(F.collect_set(F.when(F.col("form") != PLAIN, F.col("at"))).over(whole)))
    left = asked.select("h", "size", "form", "n_templates", F.col("k").alias("item_id"), F.col("at").alias("i"), F.col("slots").alias("a"), "n_words")
    right = seen.select("h", "size", "form", F.col("k").alias("doc_id"), F.col("at").alias("j"), F.col("slots").alias("b"))
    met = right.join(left, ["h", "size", "form"]).where(F.size("a") == F.size("b"))
    pairs = F.arrays_zip("a", "b")
    diagonal = met.groupBy("doc_id", "item_id", "size", (F.col("j") - F.col("i")).alias("diagonal")).agg(
        F.collect_set(F.struct("i", "form", pairs.alias("pairs"))).alias("windows"),
        F.max("n_words").alias("n_words"),
        F.max("n_templates").alias("n_templates"),
    )
    # sparse windows speak, for or against, only where the whole item is there
    all_there = F.size(F.array_distinct(F.expr("transform(filter(windows, w -> w.form != 0), w -> w.i)"))) == F.col("n_templates")
    slots = F.array_distinct(F.flatten(F.expr(f"transform(filter(windows, w -> all_there OR w.form != {SPARSE}), w -> w.pairs)")))
    diagonal = diagonal.withColumn("all_there", all_there).withColumn("pairs", slots)
    against = F.expr("filter(pairs, p -> exists(pairs, q -> (p.a = q.a) != (p.b = q.b)))")
    diagonal = diagonal.withColumn("against", against).select(
        "doc_id",
        "item_id",
        "size",
        "n_words",
        (F.size("against") == 0).alias("whole"),
        F.inline(
            F.expr(
                f"""transform(windows, w -> struct(w.i AS i, w.form = {PLAIN} AS same, CASE
                    WHEN w.form = {SPARSE} THEN all_there AND size(against) = 0
                    ELSE forall(w.pairs, p -> NOT array_contains(against, p)) END AS agrees))"""
            )
        ),
    )
    covered = (
        diagonal.where("same or agrees")
        .groupBy("doc_id", "item_id", "size", "i")
        .agg(F.max("n_words").alias("n_words"), F.bool_or("whole").alias("whole"), F.bool_or("same").alias("same"))
    )
    pair = ["doc_id", "item_id", "size"]
    onward = Window.partitionBy(*pair).orderBy("i")
    step = F.coalesce(F.col("i") - F.lag("i").over(onward), F.lit(1 << 30))
    # words between this window and the one before; a window's worth of them ends the stretch
    stretches = covered.withColumn("step", step).withColumn(
        "stretch", F.sum((F.col("step") >= 2 * F.col("size")).cast("int")).over(onward)
    )
    runs = stretches.groupBy(*pair, "stretch").agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.count_if("whole").alias("n_whole"),
        F.bool_and("same").alias("exact"),
        # each window adds its words that the one before does not hold
        F.sum(F.least("step", "size")).alias("words"),
        F.max("n_words").alias("n_words"),
    )
    found = runs.groupBy(*pair).agg(
        F.sum("n_windows").alias("n_windows"),
        F.sum("n_whole").alias("n_whole"),
        F.bool_and("exact").alias("exact"),
        F.max("words").alias("words"),
        F.max("n_words").alias("n_words"),
    )
    of_item = F.col("n_words") - F.col("size") + 1
    share = F.col("n_windows") / of_item
    good = (F.col("n_whole") / of_item >= least_share) | (share >= CONTRADICTED_SHARE) | (F.col("words") >= LEAST_RUN)
    return (
        found.where(good)
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_windows").alias("n_windows"), F.max(share).alias("share"), F.bool_or("exact").alias("exact"))
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a benchmark item; rows with a null id stay."""
    bad = saved(leaks(documents, benchmark).select("doc_id").distinct())
    return documents.join(small_side(bad), "doc_id", "left_anti").select(documents.columns)
