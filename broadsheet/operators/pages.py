"""Index pages: text lines worth reading, and the articles they link to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.fixed_values import HEADER_PHRASES, SOURCES
from broadsheet.functions import html
from broadsheet.functions.dates import DATE_IN_TEXT, parse_date, wall_clock
from broadsheet.functions.text import bind, contains_any, has_two_words, strip
from broadsheet.operators.dedup import dedup_first
from broadsheet.operators.lookup import fallback_content
from broadsheet.operators.normalize import normalize
from broadsheet.settings import Settings
from broadsheet.sources.landing import item_order

_LINE_DATE = (
    r"(?i)\d{4}[-/]\d{1,2}[-/]\d{1,2}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]* \d{1,2}"
)
_LINK = r"\[([^\]\n]+)\]\(([^)\n]+)\)"


def extract_links(pages: DataFrame) -> DataFrame:
    """One row per link with a text: page_id, pos, text, href."""
    links = F.explode(html.page_links(F.col("html"), F.col("url"))).alias("link")
    return pages.select("page_id", links).select("page_id", "link.pos", "link.text", "link.href")


def page_contents(pages: DataFrame, times: bool = True) -> DataFrame:
    """page_id, url and the text of each page."""
    return pages.select("page_id", "url", html.page_text(F.col("html"), F.col("url"), times).alias("content"))


def drop_images(markdown: Column) -> Column:
    """Remove images and links without text from markdown."""
    return F.regexp_replace(F.regexp_replace(markdown, r"!\[.*?\]\(.*?\)", ""), r"\[\s*\]\(.*?\)", "")


def header_phrases(settings: Settings) -> list[str]:
    """The run date in three notations and the fixed header phrases, lower case."""
    day = settings.as_of
    notations = (day.strftime("%B %d, %Y"), day.strftime("%d %B %Y"), day.strftime("%Y-%m-%d"))
    return [text.lower() for text in (*notations, *HEADER_PHRASES)]


def kept_lines(content: Column, settings: Settings) -> Column:
    """The lines worth reading, as an array: with a date or a link, longer than 40 characters, or
    with a keyword; short header lines with the run date are left out."""
    lines = F.transform(F.split(drop_images(content), "\n"), strip)

    def keep(line: Column) -> Column:
        lower = F.lower(line)
        header = F.lit(False)
        for phrase in header_phrases(settings):
            header = header | lower.contains(phrase)
        has_link = line.contains("[") & line.contains("](")
        wanted = (
            has_link | (F.length(line) > 40) | line.rlike(_LINE_DATE) | contains_any(line, settings.line_keywords)
        )
        return (line != "") & ~(header & (F.length(line) < 50)) & wanted

    kept = F.filter(lines, keep)
    return kept if settings.max_page_lines is None else F.slice(kept, 1, settings.max_page_lines)


def reading_text(content: Column, settings: Settings) -> Column:
    return F.array_join(kept_lines(content, settings), "\n")


def page_lines(contents: DataFrame, settings: Settings) -> DataFrame:
    """One row per kept line: page_id, line_no from 0, line."""
    return contents.select("page_id", F.posexplode(kept_lines(F.col("content"), settings)).alias("line_no", "line"))


# Reading texts (page_id, content) to items: page_id, pos, title, url, date, reasoning.
Harvester = Callable[[DataFrame], DataFrame]


def link_lines(contents: DataFrame, settings: Settings) -> DataFrame:
    """The harvester by rules: one item per link line of a reading text.

    The date is the first one on the same line, else on the next line unless that is a link line
    itself, else empty: no date is guessed. Everything happens within the row of the page, so
    pages spread freely over tasks.
    """
    text = F.col("content")
    if settings.max_page_chars is not None:
        text = F.substring(text, 1, settings.max_page_chars)

    def with_next(lines: Column) -> Column:
        # F.get gives NULL behind the last line.
        return F.transform(
            lines,
            lambda line, at: F.struct(at.alias("pos"), line.alias("line"), F.get(lines, at + 1).alias("after")),
        )

    pairs = bind(F.split(text, "\n"), with_next)
    rows = contents.select("page_id", F.explode(pairs).alias("pair")).select("page_id", "pair.*")
    # The target of the link is no text; a date in it is found later, through the url.
    own = F.regexp_extract(F.regexp_replace("line", _LINK, "$1"), DATE_IN_TEXT, 0)
    following = F.when(~F.col("after").rlike(_LINK), F.regexp_extract("after", DATE_IN_TEXT, 0))
    return rows.filter(F.col("line").rlike(_LINK)).select(
        "page_id",
        "pos",
        strip(F.regexp_extract("line", _LINK, 1)).alias("title"),
        F.regexp_extract("line", _LINK, 2).alias("url"),
        F.when(own != "", own).otherwise(F.coalesce(following, F.lit(""))).alias("date"),
        F.lit("").alias("reasoning"),
    )


def harvest(contents: DataFrame, settings: Settings, harvester: Harvester | None = None) -> DataFrame:
    """Items of reading texts with a title of two words or more and a date inside the window.

    A harvester other than the rules (a model in ``mapInPandas``, say) may give its reasoning.
    """
    found = link_lines(contents, settings) if harvester is None else harvester(contents)
    published = parse_date(F.col("date"), F.col("url"), settings.as_of)
    return found.filter(has_two_words(F.col("title"))).filter(
        F.coalesce(published >= wall_clock(settings.cutoff), F.lit(False))
    )


def collect_pages(
    pages: DataFrame,
    settings: Settings,
    api_source: str = "official_scrape",
    alternatives: DataFrame | None = None,
    harvester: Harvester | None = None,
) -> DataFrame:
    """Articles of index pages (page_id, url, html), each canonical url once.

    Official pages keep ``<time>`` texts, state-media pages do not. Pages with little text take
    the alternative rendering (url, content) where there is one. A url counts as seen only once
    an article with it passed every test.
    """
    contents = page_contents(pages, times=api_source == "official_scrape")
    contents = contents.withColumn("content", reading_text(F.col("content"), settings))
    if alternatives is not None:
        other = alternatives.withColumn("content", reading_text(F.col("content"), settings))
        contents = fallback_content(contents, other.filter(F.col("content") != ""), settings.min_page_chars)
    found = harvest(contents, settings, harvester)
    items = found.select(
        item_order(SOURCES.index(api_source), F.col("page_id"), F.col("pos")).alias("ord"),
        "title",
        "url",
        F.col("date").alias("seendate"),
        "reasoning",
        F.lit(api_source).alias("api_source"),
    )
    return dedup_first(normalize(items, settings))
