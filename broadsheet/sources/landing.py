"""Landed payloads of the six kinds of source to raw items.

A payload table has ``payload_no`` (its place in the request order) and ``payload`` (the whole
text). Items get an ``ord`` that sorts by source, payload and place in the payload, so that every
later step has a total order and none depends on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet import fixed_values as fixed
from broadsheet.functions.dates import date_from_url, mail_or_raw, millis_stamp, seendate
from broadsheet.functions.text import contains_any, repair_ampersands
from broadsheet.functions.urls import url_path_date
from broadsheet.operators.lookup import resolve_urls
from broadsheet.operators.rank import number_rows
from broadsheet.schema import GDELT_PAYLOAD, RSS_ITEM, SEARCH_PAYLOAD
from broadsheet.settings import Settings

_POSITION_BITS = 24
_PAYLOAD_BITS = 32


def item_order(source_rank: int, payload_no: Column, position: Column) -> Column:
    """One BIGINT that sorts by source, payload, position."""
    fits = (payload_no < (1 << _PAYLOAD_BITS)) & (position < (1 << _POSITION_BITS))
    order = (
        F.lit(source_rank << (_PAYLOAD_BITS + _POSITION_BITS)).cast("bigint")
        + F.shiftleft(payload_no.cast("bigint"), _POSITION_BITS)
        + position
    )
    return F.when(fits, order).otherwise(F.raise_error(F.lit("payload number or position out of range")).cast("bigint"))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as payloads with a ``payload_no`` each: that of the folder ``payload_no=N``, which
    must then hold one file, else the file's place in the order of paths, from 0."""
    files = spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")
    if "payload_no" in files.columns:
        # Listing the files does not read them.
        listed = spark.read.format("binaryFile").load(path).select("payload_no")
        crowded = listed.groupBy("payload_no").count().filter("count > 1").head(1)
        if crowded:
            raise ValueError(f"{path}: several files under payload_no={crowded[0][0]}")
        return files.select(F.col("payload_no").cast("bigint").alias("payload_no"), "payload")
    listed = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    numbered = number_rows(listed, [F.col("_file").asc()]).select("_file", (F.col("idx") - 1).alias("payload_no"))
    placed = spark.read.text(path, wholetext=True).select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("_file"))
    return placed.join(numbered, "_file").select("payload_no", "payload")


def _items(rows: DataFrame, source: str, **columns: Column) -> DataFrame:
    order = item_order(fixed.SOURCES.index(source), F.col("payload_no"), F.col("pos"))
    return rows.select(
        order.alias("ord"), *(value.alias(name) for name, value in columns.items()), F.lit(source).alias("api_source")
    )


def _first(rows: DataFrame, n: int | None) -> DataFrame:
    return rows if n is None else rows.filter(F.col("pos") < n)


def gdelt_items(payloads: DataFrame, settings: Settings) -> DataFrame:
    """Articles of ``{"articles": [...]}`` payloads."""
    parsed = payloads.select("payload_no", F.from_json("payload", GDELT_PAYLOAD).alias("json"))
    rows = parsed.select("payload_no", F.posexplode("json.articles").alias("pos", "item"))
    rows = _first(rows, settings.gdelt_records)
    item = F.col("item")
    return _items(
        rows, "gdelt", title=item["title"], url=item["url"], seendate=item["seendate"], reasoning=F.lit("")
    )


def gdelt_listing(payloads: DataFrame, label: str) -> DataFrame:
    """All fields of the articles of one labelled request, with their place in it."""
    parsed = payloads.select("payload_no", F.from_json("payload", GDELT_PAYLOAD).alias("json"))
    rows = parsed.select("payload_no", F.posexplode("json.articles").alias("pos", "item"))
    return rows.select("payload_no", "pos", "item.*", F.lit(label).alias("api_source"))


def search_items(payloads: DataFrame, settings: Settings) -> DataFrame:
    """Results of ``{"results": [...]}`` payloads, one payload per query; the content is the snippet."""
    parsed = payloads.select("payload_no", F.from_json("payload", SEARCH_PAYLOAD).alias("json"))
    rows = parsed.select("payload_no", F.posexplode("json.results").alias("pos", "item"))
    rows = _first(rows, settings.search_results_per_query)
    item = F.col("item")
    return _items(
        rows,
        "tavily",
        title=item["title"],
        url=item["url"],
        seendate=item["published_date"],
        reasoning=item["content"],
    )


def feed_rows(payloads: DataFrame) -> DataFrame:
    """payload_no, pos and the fields of each ``<item>``; items with broken XML are left out.

    Items are cut out by pattern, so that a broken one does not take its feed along.
    """
    blocks = F.regexp_extract_all("payload", F.lit(r"(?s)<item>(.*?)</item>"), F.lit(1))
    rows = payloads.select("payload_no", F.posexplode(blocks).alias("pos", "block"))
    xml = F.concat(F.lit("<root>"), repair_ampersands(F.col("block")), F.lit("</root>"))
    parsed = F.from_xml(xml, RSS_ITEM, {"ignoreSurroundingSpaces": "false"})
    fields = rows.select("payload_no", "pos", parsed.alias("item")).select("payload_no", "pos", "item.*")
    return fields.filter(F.col("title").isNotNull() | F.col("link").isNotNull())


def rss_items(payloads: DataFrame, settings: Settings) -> DataFrame:
    """Feed items with a link and a keyword in title or link. The date comes from an ``/art/`` url,
    else from a digits-only pubDate; other pubDates count as unknown."""
    rows = feed_rows(payloads).filter(F.coalesce("link", F.lit("")) != "")
    title = F.coalesce("title", F.lit(""))
    rows = rows.filter(contains_any(title, settings.feed_keywords) | contains_any(F.col("link"), settings.feed_keywords))
    date = F.coalesce(url_path_date(F.col("link")), millis_stamp(F.col("pubDate")), F.lit(""))
    return _items(rows, "rss", title=title, url=F.col("link"), seendate=date, reasoning=F.col("description"))


def google_news_items(payloads: DataFrame, settings: Settings, url_map: DataFrame | None = None) -> DataFrame:
    """The first items of a news-aggregator feed, links resolved through (src_url, final_url).
    A date in the final url overrides the feed's."""
    rows = _first(feed_rows(payloads), settings.google_news_items)
    if url_map is not None:
        rows = resolve_urls(rows, url_map, "link")
    from_url = date_from_url(F.col("link"))
    date = F.when(from_url.isNotNull(), seendate(from_url)).otherwise(
        F.coalesce(mail_or_raw(F.col("pubDate")), F.lit(""))
    )
    return _items(rows, "google_news", title=F.col("title"), url=F.col("link"), seendate=date, reasoning=F.col("description"))


def atom_entries(payloads: DataFrame) -> DataFrame:
    """payload_no, pos, title and date of the ``<entry>`` elements of Atom feeds. The date is
    pubDate, else published, else the feed's lastBuildDate."""

    def element(text: str | Column, name: str) -> Column:
        content = F.regexp_extract(text, rf"(?s)<(?:\w+:)?{name}(?:\s[^>]*)?>\s*(.*?)\s*</(?:\w+:)?{name}\s*>", 1)
        return F.when(content != "", content)

    blocks = F.regexp_extract_all("payload", F.lit(r"(?s)<(?:\w+:)?entry(?:\s[^>]*)?>(.*?)</(?:\w+:)?entry\s*>"), F.lit(1))
    rows = payloads.select(
        "payload_no", element("payload", "lastBuildDate").alias("built"), F.posexplode(blocks).alias("pos", "entry")
    )
    date = F.coalesce(element("entry", "pubDate"), element("entry", "published"), F.col("built"))
    return rows.select("payload_no", "pos", element("entry", "title").alias("title"), date.alias("date"))


def read_gdelt(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    return gdelt_items(read_payloads(spark, path), settings)


def read_search(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    return search_items(read_payloads(spark, path), settings)


def read_rss(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    return rss_items(read_payloads(spark, path), settings)


def read_google_news(spark: SparkSession, path: str, settings: Settings, url_map: DataFrame | None = None) -> DataFrame:
    return google_news_items(read_payloads(spark, path), settings, url_map)


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    return atom_entries(read_payloads(spark, path))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Index pages from parquet: page_id, url, html."""
    return spark.read.schema("page_id BIGINT, url STRING, html STRING").parquet(path)


def union_sources(*sources: DataFrame) -> DataFrame:
    """All items of all sources; duplicates stay, ``ord`` carries the merge order."""
    result = sources[0]
    for source in sources[1:]:
        result = result.unionByName(source)
    return result


def enabled(items: DataFrame, settings: Settings) -> DataFrame:
    """Items of the sources that are switched on."""
    return items.filter(F.col("api_source").isin(*settings.enabled_sources))
