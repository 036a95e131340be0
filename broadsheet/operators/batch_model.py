"""Models that answer prompts in batches, as scorers, date extractors and reviewers of the other operators.

A model is a function without arguments that sets it up, once in each task, and returns a function from a list of
prompts to a list of replies. A batch that fails is asked again row by row, so that one bad row costs only
itself; its error is kept beside it. A set-up that fails fails the task, which Spark tries again. Rows of a task
that runs again after a lost executor are asked again: replies should not depend on when they are asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.text import fenced_block
from broadsheet.operators.relevance import Scorer
from broadsheet.operators.triage import Reviewer
from broadsheet.operators.validate import DateExtractor

Reply = Callable[[list[str]], list[str]]
Model = Callable[[], Reply]
BATCH_ROWS = 64
REVIEW_ROWS = 150


def _told(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"


def _answers(reply: Reply, prompts: list[str]) -> list[tuple[str | None, str | None]]:
    """Reply and error of each prompt, one of them null."""
    try:
        found = reply(prompts)
        if len(found) != len(prompts):
            raise ValueError(f"{len(found)} replies to {len(prompts)} prompts")
        return [(answer, None) for answer in found]
    except Exception as error:  # any failure of the model is a result of its row
        if len(prompts) == 1:
            return [(None, _told(error))]
        return [pair for prompt in prompts for pair in _answers(reply, [prompt])]


def ask(df: DataFrame, prompt: Column, model: Model, batch_rows: int = BATCH_ROWS, reply: str = "reply", error: str = "error") -> DataFrame:
    """df with the model's reply to each prompt, or the error; a null prompt counts as empty. One narrow pass."""
    taken = {name.lower() for name in df.columns}
    if taken & {reply.lower(), error.lower()}:
        raise ValueError(f"the table already has a column {reply} or {error}")
    asked = "_prompt"
    while asked in taken:
        asked += "_"
    schema = T.StructType([*df.schema.fields, T.StructField(reply, T.StringType()), T.StructField(error, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: Reply | None = None
        for batch in batches:
            place = batch.schema.get_field_index(asked)
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                ready = ready or model()
                pairs = _answers(ready, part.column(place).to_pylist())
                columns = [column for i, column in enumerate(part.columns) if i != place]
                columns += [pa.array([pair[side] for pair in pairs], pa.string()) for side in (0, 1)]
                names = [name for i, name in enumerate(part.schema.names) if i != place]
                yield pa.RecordBatch.from_arrays(columns, [*names, reply, error])

    return df.withColumn(asked, F.coalesce(prompt, F.lit(""))).mapInArrow(run, schema)


def _article() -> Column:
    return F.concat_ws("\n", "title", "domain", "reasoning")


def batch_scorer(model: Model, prompt: Callable[[], Column] = _article, batch_rows: int = BATCH_ROWS) -> Scorer:
    """Relevance by replies of the form ``{"is_relevant": "YES", "reasoning": "…"}``, fenced or not. A row
    whose prompt failed, or whose reply cannot be read, is answered NO and goes; ``error`` says why."""

    def score(df: DataFrame) -> DataFrame:
        replied = ask(df, prompt(), model, batch_rows, "_reply", "error")
        parsed = replied.withColumn("_read", F.from_json(fenced_block(F.col("_reply")), "is_relevant STRING, reasoning STRING"))
        unread = F.when(F.col("error").isNull() & F.col("_read.is_relevant").isNull(), F.lit("unreadable reply"))
        return parsed.withColumns(
            {
                "error": F.coalesce("error", unread),
                "is_relevant": F.coalesce("_read.is_relevant", F.lit("NO")),
                "reasoning": F.coalesce("_read.reasoning", F.lit("")),
            }
        ).drop("_reply", "_read")

    return score


def batch_extractor(model: Model, prompt: Callable[[], Column] = _article, batch_rows: int = BATCH_ROWS) -> DateExtractor:
    """Dates by replies that are the date as text; a row whose prompt failed has none."""

    def extract(df: DataFrame) -> DataFrame:
        return ask(df, prompt(), model, batch_rows, "date_str", "_error").drop("_error")

    return extract


def batch_reviewer(model: Model, block: int = REVIEW_ROWS, batch_rows: int = 1) -> Reviewer:
    """Review by replies of the form ``{"retained_indices": [0, 2]}``, fenced or not, to lists of ``block`` neighbours.

    A prompt has a line ``[i] (domain): title`` for each article, i from 0 in each list. A list whose prompt
    failed, or whose reply cannot be read, stays whole; numbers beyond a list are ignored. A list is one row of
    at most ``block`` lines, so nothing is gathered that grows with the input.
    """

    def review(items: DataFrame) -> DataFrame:
        place = F.col("pos") % block
        line = F.concat(F.lit("["), place.cast("string"), F.lit("] ("), F.coalesce("domain", F.lit("source")), F.lit("): "), F.coalesce("title", F.lit("")))
        lists = items.groupBy(F.floor(F.col("pos") / block).alias("list")).agg(
            F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("lines")
        )
        replied = ask(lists, F.array_join(F.col("lines.line"), "\n"), model, batch_rows, "_reply", "_error")
        kept = F.from_json(fenced_block(F.col("_reply")), "retained_indices ARRAY<BIGINT>")["retained_indices"]
        positions = F.col("lines.pos")
        chosen = F.filter(positions, lambda pos: kept.isNull() | F.coalesce(F.array_contains(kept, (pos % block).cast("bigint")), F.lit(False)))
        return replied.select(F.explode(chosen).alias("index"))

    return review
