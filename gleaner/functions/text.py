"""Whitespace, tokenising and answer clean-up as native column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Tokeniser = Callable[[Column], Column]

# Unicode white space plus the four ASCII separators that str.split() also breaks on.
SPACE = r"[\s\x1c-\x1f]"


def strip_ws(text: Column) -> Column:
    """Trim every kind of white space; Spark's ``trim`` only removes blanks."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip_ws(text) == "", F.lit(True))


def tokenise(text: Column, lowercase: bool = False) -> Column:
    """White-space tokens in order; case and punctuation stay unless ``lowercase``."""
    source = F.lower(text) if lowercase else text
    return F.filter(F.split(source, rf"(?U){SPACE}+"), lambda token: token != "")


def tokenise_lower(text: Column) -> Column:
    return tokenise(text, lowercase=True)


def tokeniser_without(stop_words: Sequence[str], punctuation: str = r"\p{Punct}") -> Tokeniser:
    """Lower-casing tokeniser that strips punctuation and drops a fixed word list."""
    words = F.array(*[F.lit(w) for w in stop_words]) if stop_words else None

    def tokens(text: Column) -> Column:
        found = tokenise(F.regexp_replace(F.lower(text), punctuation, ""))
        return found if words is None else F.filter(found, lambda t: ~F.array_contains(words, t))

    return tokens


def after_marker(text: Column, marker: str) -> Column:
    """Trimmed text after the first ``marker``; the whole trimmed text when it is absent."""
    return strip_ws(F.element_at(F.split(text, rf"\Q{marker}\E", 2), -1))


def strip_think(text: Column) -> Column:
    """Remove every closed reasoning span, across lines."""
    return strip_ws(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))
