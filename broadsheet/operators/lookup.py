"""Joins with side tables. Join strategies follow the optimizer's size checks, not hints.

Every look-up gives one row per input row. Where a side table repeats a key, the row that comes first
counts: by its ``ord`` if it has one, else by value, nulls last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(side: DataFrame, key: str, value: str) -> DataFrame:
    """``_key`` and ``_value``: the first value of each key. Partial aggregation keeps a repeated key small."""
    place = F.col("ord") if "ord" in side.columns else F.lit(0)
    named = side.select(F.col(key).alias("_key"), F.col(value).alias("_value"), place.alias("_place"))
    order = F.struct("_place", F.col("_value").isNull().alias("_null"), F.col("_value").alias("_of"))
    return named.groupBy("_key").agg(F.min_by(F.struct("_value"), order).alias("_first")).select("_key", "_first._value")


def lookup_tier(df: DataFrame, tiers: DataFrame, default: int = 1, column: str = "domain", unique: bool = False) -> DataFrame:
    """Add ``tier`` from a table of (domain, tier), exact match, ``default`` for other domains. A table known to have each
    domain once (``unique``), such as one made of settings, need not be reduced first."""
    side = tiers.select(F.col("domain").alias("_key"), F.col("tier").alias("_value")) if unique else _one_per_key(tiers, "domain", "tier")
    joined = df.drop("tier").join(side, F.col(column) == F.col("_key"), "left")
    return joined.withColumn("tier", F.coalesce("_value", F.lit(default)).cast("int")).drop("_key", "_value")


def resolve_urls(df: DataFrame, url_map: DataFrame, column: str = "url") -> DataFrame:
    """Replace opaque links by their targets (src_url, final_url); unknown links stay."""
    side = _one_per_key(url_map, "src_url", "final_url")
    joined = df.join(side, F.col(column) == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_value", column)).drop("_key", "_value")


def fallback_content(pages: DataFrame, alternatives: DataFrame, min_chars: int = 300) -> DataFrame:
    """Replace ``content`` that is missing or shorter than ``min_chars`` by an alternative
    rendering (url, content), where there is one. Long contents take no part in the join."""
    short = F.coalesce(F.length("content"), F.lit(0)) < min_chars
    side = _one_per_key(alternatives, "url", "content")
    repaired = pages.filter(short).join(side, F.col("url") == F.col("_key"), "left")
    repaired = repaired.withColumn("content", F.coalesce("_value", "content")).drop("_key", "_value")
    return pages.filter(~short).unionByName(repaired)


def retain(items: DataFrame, indices: DataFrame, position: str = "pos") -> DataFrame:
    """Items at the listed positions (column ``index``); an index listed twice gives two rows,
    one beyond the list gives none."""
    return items.join(indices.select(F.col("index").alias("_index")), F.col(position) == F.col("_index")).drop("_index")
