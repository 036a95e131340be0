"""Configured lists as small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import fixed_values as fixed


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Constant rows whose small size the optimizer can see, so that joins with them need no
    shuffle (rows handed over from Python would have no known size)."""
    names = [column.split()[0] for column in schema.split(", ")]
    constants = [F.struct(*(F.lit(value).alias(name) for name, value in zip(names, row))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*constants))).to(spark.createDataFrame([], schema).schema)


def tier_table(spark: SparkSession, tiers: dict[str, int] | None = None) -> DataFrame:
    """domain, tier."""
    return _table(spark, list((tiers or fixed.SOURCE_TIERS).items()), "domain STRING, tier INT")


def keyword_table(spark: SparkSession) -> DataFrame:
    """kind, keyword of the feed and page-line keywords."""
    rows = [("feed", word) for word in fixed.FEED_KEYWORDS] + [("line", word) for word in fixed.LINE_KEYWORDS]
    return _table(spark, rows, "kind STRING, keyword STRING")


def page_table(spark: SparkSession) -> DataFrame:
    """page_no, url, api_source of the index pages: official ones first, then state media."""
    urls = [(url, "official_scrape") for url in fixed.OFFICIAL_PAGES]
    urls += [(url, "chinese_state_media") for url in fixed.STATE_MEDIA_PAGES]
    return _table(spark, [(i, *row) for i, row in enumerate(urls)], "page_no INT, url STRING, api_source STRING")


def feed_table(spark: SparkSession) -> DataFrame:
    """feed_no, url of the RSS feeds, in request order."""
    return _table(spark, list(enumerate(fixed.RSS_FEEDS)), "feed_no INT, url STRING")
