"""JSON-lines, Parquet, CSV and column-list sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from gleaner.functions.display import compact_nested
from gleaner.sources.writers import with_row_index

_TEXT = StringType()
_LINKS = ArrayType(MapType(_TEXT, _TEXT))

# Declared, not inferred: inference costs a pass over the text and turns the map into a struct.
REVIEWS = StructType(
    [
        StructField("parent_asin", _TEXT),
        StructField("title", _TEXT),
        StructField("helpful_vote", LongType()),
        StructField("rating", DoubleType()),
        StructField("text", _TEXT),
        StructField("asin", _TEXT),
        StructField("user_id", _TEXT),
        StructField("timestamp", LongType()),
        StructField("verified_purchase", BooleanType()),
        StructField("images", _LINKS),
    ]
)
META = StructType(
    [
        StructField("parent_asin", _TEXT),
        StructField("main_category", _TEXT),
        StructField("title", _TEXT),
        StructField("features", ArrayType(_TEXT)),
        StructField("description", ArrayType(_TEXT)),
        StructField("details", MapType(_TEXT, _TEXT)),
        StructField("average_rating", DoubleType()),
        StructField("rating_number", LongType()),
        StructField("price", _TEXT),
        StructField("store", _TEXT),
        StructField("images", _LINKS),
        StructField("videos", _LINKS),
        StructField("subtitle", _TEXT),
        StructField("author", _TEXT),
        StructField("bought_together", _TEXT),
    ]
)
REVIEW_COLUMNS = ("parent_asin", "title", "helpful_vote")
BAD_RECORD = "_bad_record"


def narrow(schema: StructType, columns: Sequence[str]) -> StructType:
    """The named fields only; for JSON a narrow schema is the column pruning."""
    return StructType([schema[c] for c in columns])


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: StructType, malformed: str = "null", spread: int | None = None
) -> DataFrame:
    """JSON lines, plain or gzipped, with a declared (narrow) schema.

    A malformed line becomes a row of nulls (``null``), is left out (``drop``), or
    is kept beside the nulls in ``_bad_record`` (``keep``).  A value of the wrong
    type is null by itself.

    A gzip file cannot be split: one task reads it.  With ``spread`` its lines are dealt
    to that many tasks before they are parsed, for few large files.
    """
    if malformed not in ("null", "keep", "drop"):
        raise ValueError(f"unknown malformed mode {malformed!r}")
    if malformed == "drop" and not spread:
        return spark.read.option("mode", "DROPMALFORMED").schema(schema).json(path)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    wanted = StructType([*schema.fields, StructField(BAD_RECORD, _TEXT)])
    if spread:
        lines = spark.read.text(path).where(F.trim("value") != "").repartition(spread)
        read = lines.select(F.from_json("value", wanted, options).alias("r")).select("r.*")
    else:
        read = spark.read.options(**options).schema(wanted).json(path)
    # The reader keeps the fields before a syntax error; such a line should hold nothing.
    bad = F.col(BAD_RECORD)
    whole = bad.isNull() | F.get_json_object(bad, "$").isNotNull()
    if malformed == "drop":
        return read.where(bad.isNull()).select(*schema.names)
    columns = [F.when(whole, F.col(name)).alias(name) for name in schema.names]
    return read.select(*columns, *([bad] if malformed == "keep" else []))


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = REVIEW_COLUMNS,
    malformed: str = "null",
    spread: int | None = None,
) -> DataFrame:
    """Reviews; only the named columns are parsed."""
    return read_json_lines(spark, path, narrow(REVIEWS, columns), malformed, spread)


def read_meta(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    malformed: str = "null",
    spread: int | None = None,
) -> DataFrame:
    """Product metadata; ``details`` is a map, nested values stay as compact JSON text."""
    schema = META if columns is None else narrow(META, columns)
    rows = read_json_lines(spark, path, schema, malformed, spread)
    if "details" not in schema.names:
        return rows
    return rows.withColumn("details", compact_nested(F.col("details")))


def category_files(root: str, subsets: Sequence[str], meta: bool = True, reviews: bool = True) -> dict[str, list[str]]:
    """Paths of category files: ``{subset}.jsonl.gz`` and ``meta_{subset}.jsonl.gz``."""
    base = root.rstrip("/")
    files = {}
    if reviews:
        files["reviews"] = [f"{base}/{s}.jsonl.gz" for s in subsets]
    if meta:
        files["meta"] = [f"{base}/meta_{s}.jsonl.gz" for s in subsets]
    return files


def read_category(
    spark: SparkSession, root: str, subsets: Sequence[str], meta: bool = True, reviews: bool = True
) -> dict[str, DataFrame]:
    """All categories of a side in one read, tagged with the category of their file."""
    sides = {"reviews": (read_reviews, ""), "meta": (read_meta, "meta_")}
    tables = {}
    for side, paths in category_files(root, subsets, meta, reviews).items():
        read, prefix = sides[side]
        # The category is a file, or a folder of files with the same name.
        name = F.regexp_extract("_metadata.file_path", rf"/{prefix}([^/]+)\.jsonl\.gz(?:/|$)", 1)
        tables[side] = read(spark, paths).select("*", name.alias("subset"))
    return tables


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_queries(spark: SparkSession, path: str, column: str = "queries") -> DataFrame:
    """Query set from a CSV with a header, numbered by file path and place in the file."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    # A file is read by one task from its start to its end, so inside it the id ascends.
    placed = rows.select(
        F.col(column).alias("query"), F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at")
    )
    return with_row_index(placed, ["_file", "_at"], "query_id").select("query_id", "query")


def single_query(spark: SparkSession, text: str) -> DataFrame:
    """A one-row query set."""
    return spark.range(1).select(F.col("id").alias("query_id"), F.lit(text).alias("query"))


def read_column_list(spark: SparkSession, path: str) -> list[str]:
    """Column names, one per line, blanks dropped."""
    name = F.regexp_replace("value", r"(?U)^\s+|\s+$", "")
    rows = spark.read.text(path, wholetext=False).select(name.alias("name")).where("name <> ''")
    return [row["name"] for row in rows.collect()]
