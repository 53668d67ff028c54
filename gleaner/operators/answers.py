"""Contexts, prompts, batch generation and model comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.display import hit_block, title_block
from gleaner.functions.text import after_marker

Generator = Callable[[list[str]], list[str]]

# Section headings of a prompt, and the error prefix of a failed answer.
CONTEXT_HEADING = "context:\n"
QUESTION_HEADING = "question:\n"
ERROR_PREFIX = "Error: "
MAX_PROMPTS = 1000
# Prompts sent to a generator at a time; halved when they fail together.
REQUEST_ROWS = 64

# The one prompt that comes with the engine; others are rows of a user's table.
SYSTEM_TEXT = "Answer the question from the numbered facts you are given. If they do not settle it, say so."


def context_by_query(
    hits: DataFrame,
    key: str = "parent_asin",
    title: str = "product_title",
    rating: str = "average_rating",
    text: str = "text",
    titles_only: bool = False,
) -> DataFrame:
    """``(query_id, context)``: the blocks of a query's hits in rank order, a blank line apart."""
    if titles_only:
        block = title_block(F.col(key), F.col(title))
    else:
        block = hit_block(F.col(key), F.col(title), F.col(rating), F.col(text))
    blocks = hits.select("query_id", "rank", block.alias("block"))
    joined = F.expr("listagg(block, '\n\n') within group (order by rank)")
    return blocks.groupBy("query_id").agg(joined.alias("context"))


def with_context(queries: DataFrame, contexts: DataFrame) -> DataFrame:
    """Every query with its context; an empty one where nothing was found."""
    return queries.join(contexts, "query_id", "left").na.fill("", ["context"])


def prompt_table(queries: DataFrame, prompts: DataFrame) -> DataFrame:
    """Each query with every prompt of a table ``(prompt_id, system_text)``.

    The prompts are a hand-written list: at most ``MAX_PROMPTS`` of them, else an error.
    """
    rows = prompts.select("prompt_id", "system_text").orderBy("prompt_id").limit(MAX_PROMPTS + 1).collect()
    if len(rows) > MAX_PROMPTS:
        raise ValueError(f"more than {MAX_PROMPTS} prompts")
    if not rows:
        return queries.select("*", F.lit("").alias("prompt_id"), F.lit("").alias("system_text")).limit(0)
    variants = F.array(
        *[F.struct(F.lit(i).alias("prompt_id"), F.lit(t).alias("system_text")) for i, t in rows]
    )
    return queries.select("*", F.inline(variants))


def chat_message(context: Column, query: Column) -> Column:
    """Human turn of the chat form: context, then question."""
    return F.concat(F.lit(CONTEXT_HEADING), context, F.lit("\n\n" + QUESTION_HEADING), query)


def full_prompt(system: Column, context: Column, query: Column, closing: str = "") -> Column:
    """Single-text form: instructions, context, question and, if there is one, a closing line."""
    end = [F.lit("\n\n" + closing)] if closing else []
    return F.concat(system, F.lit("\n\n"), chat_message(context, query), *end)


def chat_prompt(system: Column, context: Column, query: Column) -> Column:
    """System text and human turn as one prompt, without a closing line."""
    return F.concat(system, F.lit("\n\n"), chat_message(context, query))


def per_model(prompts: DataFrame, models: Sequence[str]) -> DataFrame:
    """Each prompt once per model; the context was built before, once per query."""
    return prompts.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def generate(
    prompts: DataFrame, make_generator: Callable[[str], Generator], columns: Sequence[str] = ("query_id",)
) -> DataFrame:
    """Add ``answer`` and ``error`` to rows of ``(*columns, model, prompt)``.

    ``make_generator(model)`` is called once per task and model.  Prompts go to it in
    small batches; one that fails, or brings another number of answers than prompts, is
    halved until the bad request is alone: that row's answer is the error text and the
    job goes on.  A model that cannot be made, a null one included if its factory
    refuses it, gives an error for each of its rows.
    """
    kept = [*dict.fromkeys([*columns, "model", "prompt"])]
    source = prompts.select(*kept)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    schema = ", ".join([*fields, "answer string", "error string"])

    def failed(error: Exception, texts: list[str]) -> list[tuple[str, str]]:
        return [(f"{ERROR_PREFIX}{error}", str(error))] * len(texts)

    def answer_batch(generator: Generator, texts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            answers = list(generator(texts))
            if len(answers) != len(texts):
                raise ValueError(f"{len(answers)} answers for {len(texts)} prompts")
            return [(answer, None) for answer in answers]
        except Exception as error:  # noqa: BLE001 - any failure becomes that row's text
            if len(texts) == 1:
                return failed(error, texts)
            half = len(texts) // 2
            return answer_batch(generator, texts[:half]) + answer_batch(generator, texts[half:])

    def refuse(error: Exception) -> Generator:
        def raise_it(texts: list[str]) -> list[str]:
            raise error

        return raise_it

    def answer_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generators: dict[str | None, Generator] = {}
        for batch in batches:
            for value, rows in batch.groupby("model", sort=False, dropna=False):
                model = None if pd.isna(value) else value
                if model not in generators:
                    try:
                        generators[model] = make_generator(model)
                    except Exception as error:  # noqa: BLE001 - the model's rows carry it
                        generators[model] = refuse(error)
                for start in range(0, len(rows), REQUEST_ROWS):
                    part = rows.iloc[start : start + REQUEST_ROWS]
                    answers = answer_batch(generators[model], part["prompt"].tolist())
                    yield part.assign(answer=[a for a, _ in answers], error=[e for _, e in answers])

    return source.mapInPandas(answer_all, schema)


def clean_answers(answers: DataFrame, marker: str = "</think>") -> DataFrame:
    return answers.withColumn("answer", after_marker(F.col("answer"), marker))


def compare_models(answers: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per query, one answer column per model."""
    wide = answers.groupBy("query_id", "query").pivot("model", list(models)).agg(F.first("answer"))
    return wide.select("query_id", "query", *[F.col(f"`{m}`").alias(f"{m}'s response") for m in models])


def answer_table(answers: DataFrame) -> DataFrame:
    """Long form for one model: the query and its answer."""
    return answers.select("query", F.col("answer").alias("Output Response"))
