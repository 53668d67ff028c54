"""Labels, nested-field flattening and hit blocks as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and defaults that results must carry.
MISSING_FIELD = "N/A"
MISSING_TITLE = "Unknown Product"
HIT_BLOCK = "Product ASIN: %s\nTitle: %s\nAverage Rating: %s\nContent: %s\n"
TITLE_BLOCK = "Product ASIN: %s\nTitle: %s\n"


def one_decimal(value: Column) -> Column:
    """Nearest tenth of the exact binary value, exact halves to the even tenth.

    ``format_string('%.1f')`` rounds the printed digits half up instead.  The two
    subtractions below are exact near a midpoint, so their sign decides correctly.
    """
    tenth = F.floor(value * 10)
    gap = ((2 * tenth + 1).cast("double") - 16 * value) - 4 * value
    up = (gap < 0) | ((gap == 0) & (F.pmod(tenth, F.lit(2)) == 1))
    return F.format_string("%.1f", (tenth + up.cast("int")).cast("double") / 10)


def rating_label(rating: Column) -> Column:
    """``Rating: 4.5``; no label for a missing rating."""
    return F.when(rating.isNotNull(), F.concat(F.lit("Rating: "), one_decimal(rating)))


def score_label(score: Column) -> Column:
    return F.format_string("%.4f", score)


def rank_label(rank: Column) -> Column:
    return F.concat(F.lit("#"), rank.cast("string"))


def title_with_rating(title: Column, rating: Column) -> Column:
    return F.concat(title, rating.cast("string"))


def with_default(value: Column, default: str) -> Column:
    return F.coalesce(value.cast("string"), F.lit(default))


def short_title(title: Column, length: int = 100) -> Column:
    return F.left(title, F.lit(length))


def flat_array(values: Column) -> Column:
    """Space-joined array; null elements are skipped, a null array stays null."""
    return F.array_join(values, " ")


def flat_map(entries: Column) -> Column:
    """All keys, then all values; null when the map is null."""
    return F.concat(flat_array(F.map_keys(entries)), F.lit(" "), flat_array(F.map_values(entries)))


def json_map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def compact_nested(entries: Column) -> Column:
    """Map whose nested JSON values are written without blanks between their parts."""

    def compact(value: Column) -> Column:
        wrapped = F.concat(F.lit('{"v":'), value, F.lit("}"))
        return F.when(
            value.rlike(r"^[\[{]"), F.coalesce(F.from_json(wrapped, "v string")["v"], value)
        ).otherwise(value)

    return F.transform_values(entries, lambda _, value: compact(value))


def value_type(value: Column) -> Column:
    """The type that a variant value has in its row."""
    return F.schema_of_variant(value)


def hit_block(key: Column, title: Column, rating: Column, content: Column) -> Column:
    """One hit as a labelled text block."""
    return F.format_string(
        HIT_BLOCK,
        with_default(key, MISSING_FIELD),
        with_default(title, MISSING_FIELD),
        with_default(rating, MISSING_FIELD),
        F.coalesce(content, F.lit("")),
    )


def title_block(key: Column, title: Column) -> Column:
    """The shorter block that shows only key and title."""
    return F.format_string(TITLE_BLOCK, with_default(key, MISSING_FIELD), with_default(title, ""))
