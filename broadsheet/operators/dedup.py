"""Duplicates by canonical url and title key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import title_key
from broadsheet.functions.urls import canonical_url
from broadsheet.operators.filters import filter_nonempty
from broadsheet.operators.rank import first_per_group
from broadsheet.storage import Workspace

def dedup_first(df: DataFrame, key: Column | None = None, order: list[Column] | None = None) -> DataFrame:
    """The first row of each canonical url (or other key)."""
    keyed = df.withColumn("_key", canonical_url(F.col("url")) if key is None else key)
    return first_per_group(keyed, ["_key"], order or [F.col("ord").asc()]).drop("_key")


def greedy_keys(pairs: DataFrame) -> DataFrame:
    """The ``ord`` of the rows that a walk in ``ord`` order would keep, where a row is dropped if
    its ``first`` or its (non-NULL) ``second`` key belongs to a row already kept.

    Copies with the same pair of keys fall together in a partial aggregation before anything is
    shuffled, so a group of copies costs one row per map task. Then rounds: a row that is the
    earliest of both its keys is certainly kept, and every row that shares a key with a kept one
    is certainly dropped. The earliest rows of either key are one row per key, so finding those
    that are both joins unique keys; rows without a second key need no partner and are spread by
    ``ord`` wherever the second key is joined. Each round writes one table, of the rows it keeps and
    those still open. Rounds number as the longest chain of alternating keys, a handful in
    practice.
    """
    work = Workspace(pairs.sparkSession, "greedy")
    state = work.write(pairs.groupBy("first", "second").agg(F.min("ord").alias("ord")).withColumn("open", F.lit(True)))
    kept_parts = []
    while True:
        live = state.filter("open").select("first", "second", "ord")
        if live.isEmpty():
            break
        leads = live.groupBy("first").agg(F.min(F.struct("ord", "second")).alias("lead")).select("first", "lead.*")
        earliest = live.filter(F.col("second").isNotNull()).groupBy("second").agg(F.min("ord").alias("ord"))
        paired = leads.filter(F.col("second").isNotNull()).join(earliest.select("ord"), "ord", "left_semi")
        won = paired.unionByName(leads.filter(F.col("second").isNull()))
        placed = live.join(won.select("first", F.col("ord").alias("_won")), "first", "left")
        undecided = F.col("_won").isNull()
        spread = F.concat(F.lit("o"), F.col("ord").cast("string"))
        title = F.coalesce(F.when(undecided, F.concat(F.lit("t"), "second")), spread)
        taken = won.filter(F.col("second").isNotNull()).select(F.concat(F.lit("t"), "second").alias("_title"))
        decided = placed.withColumn("_title", title).join(taken.withColumn("_taken", F.lit(True)), "_title", "left")
        kept = F.col("ord") == F.col("_won")
        still = undecided & F.col("_taken").isNull()
        state = work.write(
            decided.filter(F.coalesce(kept, F.lit(False)) | still).select("first", "second", "ord", still.alias("open"))
        )
        kept_parts.append(state.filter("NOT open").select("ord"))
    if not kept_parts:
        return state.select("ord")
    return reduce(DataFrame.unionByName, kept_parts)


def dedup_greedy(df: DataFrame) -> DataFrame:
    """Articles left after dropping, in ``ord`` order, each one whose canonical url or title key
    was kept before. Rows without url or title go; an empty title key matches nothing. A dropped
    row does not claim its keys, which is why two passes of keep-first would be wrong."""
    items = filter_nonempty(df, "url", "title")
    key = title_key(F.col("title"))
    pairs = items.select(
        "ord",
        canonical_url(F.col("url")).alias("first"),
        F.when(key != "", key).alias("second"),
    )
    return items.join(greedy_keys(pairs), "ord", "left_semi")
