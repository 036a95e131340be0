"""Counts along the way of a digest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import contains_any


def count_by_source(df: DataFrame) -> DataFrame:
    return df.groupBy("api_source").agg(F.count(F.lit(1)).alias("items"))


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per stage: its place, name and row count (0 for an empty stage)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("items")).select(F.lit(i).alias("step"), F.lit(name).alias("stage"), "items")
        for i, (name, df) in enumerate(stages.items(), 1)
    ]
    return reduce(DataFrame.unionByName, counts)


def drop_reasons(judged: DataFrame) -> DataFrame:
    """How many rows each reason dropped; kept rows count as 'kept'."""
    return judged.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("items"))


def feed_hit_rate(items: DataFrame, keywords, first: int) -> DataFrame:
    """Keyword hits among the first items of each feed (columns feed, pos, title)."""
    window = items.filter(F.col("pos") < first)
    hit = contains_any(F.col("title"), keywords)
    return window.groupBy("feed").agg(F.count_if(hit).alias("hits"), F.count(F.lit(1)).alias("seen"))


def dedup_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """Items of each source before deduplication, and how many rows are left after it."""
    sides = before.select("api_source", F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select("api_source", F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return sides.groupBy("api_source").agg(F.sum("b").alias("before"), F.sum("a").alias("after"))
