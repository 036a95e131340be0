"""An article feed over the ``documents`` table.

Each document becomes one landed item: the first sentence is its title, the whole text its
snippet, and the id decides source, host, url form and date form, so that duplicate urls, dates in
every notation and undated items all occur.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.settings import RelevanceRule, Settings

API_SOURCES = ("gdelt", "tavily", "rss", "google_news", "official_scrape", "chinese_state_media")
HOSTS = (
    "www.state.gov", "home.treasury.gov", "english.www.gov.cn", "www.reuters.com",
    "blog.example.com", "news.google.com", "www.globaltimes.cn",
)

# Run parameters that fit the feed: its dates lie in January 2024 and its words are invented.
FEED_SETTINGS = Settings(
    as_of=datetime(2024, 1, 31, 12, 0),
    tiers={"state.gov": 1, "treasury.gov": 1, "gov.cn": 1, "reuters.com": 2},
    feed_keywords=("tion", "worthless"),
    relevance_rules=(
        RelevanceRule("tion", 2, "state action"),
        RelevanceRule("edon", 1, "policy shift"),
        RelevanceRule("ment", 1, "technology"),
        RelevanceRule("worthless", -3, "opinion"),
        RelevanceRule("pathetic", -2, "noise"),
    ),
)


def _pick(values: tuple[str, ...], index):
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


DOCUMENT = "doc_id BIGINT, text STRING"


def landed_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_items(spark.read.schema(DOCUMENT).parquet(f"{sf_dir}/documents.parquet"))


def landed_stream(spark: SparkSession, directory: str, pattern: str = "documents.parquet", per_trigger: int = 1) -> DataFrame:
    """The same items as a stream over the files of a directory, ``per_trigger`` files at a time."""
    files = spark.readStream.schema(DOCUMENT).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger)
    return as_items(files.parquet(directory))


def as_items(docs: DataFrame) -> DataFrame:
    """Raw items: ord, title, url, seendate, api_source, reasoning, and the date as ``day``."""
    doc = F.col("doc_id")
    k = F.when(doc % 4 == 0, F.floor(doc / 2)).otherwise(doc)
    number = k % 30 + 1
    path_date = (
        F.when(k % 5 == 0, F.concat(F.lit("/2024/01/"), F.lpad(number.cast("string"), 2, "0")))
        .when(k % 5 == 1, F.concat(F.lit("/2024/jan/"), number.cast("string")))
        .otherwise("")
    )
    tail = (
        F.when(doc % 3 == 0, F.concat(F.lit("?utm="), doc.cast("string"))).when(doc % 3 == 1, "#top").otherwise("")
    )
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc % 30).cast("int"))
    form = doc % 8
    seendate = (
        F.when(form == 0, F.date_format(day, "yyyyMMdd"))
        .when(form == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 2, F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" 23:30:00 +0800")))
        .when(form == 3, F.date_format(day, "MMMM dd, yyyy"))
        .when(form == 4, F.date_format(day, "dd MMMM yyyy"))
        .when(form == 5, F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T100000Z")))
        .when(form == 6, "")
        .otherwise("Unknown")
    )
    note = F.when(doc % 16 >= 13, F.concat(F.lit(" (Released "), F.date_format(day, "MMMM dd, yyyy"), F.lit(")"))).otherwise("")
    return docs.select(
        doc.alias("ord"),
        F.trim(F.regexp_extract("text", r"^[^\n.!?]*", 0)).alias("title"),
        F.concat(F.lit("https://"), _pick(HOSTS, k % 7), path_date, F.lit("/story-"), k.cast("string"), tail).alias("url"),
        seendate.alias("seendate"),
        _pick(API_SOURCES, doc % 6).alias("api_source"),
        F.concat("text", note).alias("reasoning"),
        day.alias("day"),
    )
