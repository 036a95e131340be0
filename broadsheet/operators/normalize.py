"""Raw items of any source to articles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fixed
from broadsheet.functions.dates import parse_date, seendate, wall_clock
from broadsheet.functions.text import has_two_words, strip
from broadsheet.functions.urls import domain_matches, url_domain
from broadsheet.settings import Settings


def special_source(api_source: Column, domain: Column) -> Column:
    """Items that pass without an allowed domain: unresolved aggregator links, state media."""
    return ((api_source == "google_news") & domain.contains("google.com")) | (api_source == "chinese_state_media")


def date_gate(api_source: Column, raw_date: Column, published: Column, cutoff: Column) -> Column:
    """Whether an item's date lets it in.

    Most sources need a date inside the window. The news aggregator only loses items that came
    with a date and whose date is known to be old. The date is referenced once per branch, so a
    pushed-down filter evaluates it once per row.
    """
    recent = published >= cutoff
    return (
        F.when(api_source.isin(*fixed.DATED_SOURCES), F.coalesce(recent, F.lit(False)))
        .when((api_source == "google_news") & (raw_date != ""), F.coalesce(recent, F.lit(True)))
        .otherwise(True)
    )


def tier_of(domain: Column, tiers: dict[str, int], default: int) -> Column:
    """Exact-domain tier from a small configured table."""
    tier = F.lit(default)
    for value in sorted(set(tiers.values())):
        names = [name for name, rank in tiers.items() if rank == value]
        tier = F.when(domain.isin(*names), value).otherwise(tier)
    return tier.cast("int")


def describe(items: DataFrame, settings: Settings, as_of: datetime | Column | None = None) -> DataFrame:
    """Articles before the date test: with ``raw_date`` and ``published``, read as of the run time or of a
    column of moments. Nothing here depends on how long the window is.

    Missing fields count as empty. An item passes with a title of two words or more and an allowed
    domain (or a special source). One narrow stage, no shuffle; the cheap tests stand first.
    """
    read = items.select(
        "ord",
        "api_source",
        *(F.coalesce(name, F.lit("")).alias(name) for name in ("url", "reasoning")),
        F.coalesce("seendate", F.lit("")).alias("raw_date"),
        strip(F.coalesce("title", F.lit(""))).alias("title"),
        *([as_of.alias("_as_of")] if isinstance(as_of, Column) else []),
    )
    named = read.filter(has_two_words(F.col("title"))).withColumn("domain", url_domain(F.col("url")))
    allowed = named.filter(
        domain_matches(F.col("domain"), settings.allowed_domains)
        | special_source(F.col("api_source"), F.col("domain"))
    )
    moment = F.col("_as_of") if isinstance(as_of, Column) else as_of or settings.as_of
    dated = allowed.withColumn("published", parse_date(F.col("raw_date"), F.col("url"), moment))
    return dated.select(
        "ord",
        "title",
        "url",
        "domain",
        seendate(F.col("published")).alias("seendate"),
        "api_source",
        tier_of(F.col("domain"), settings.tiers, settings.default_tier).alias("tier"),
        "reasoning",
        "raw_date",
        "published",
    )


def admit(described: DataFrame, settings: Settings) -> DataFrame:
    """The articles whose date lets them into the window of the settings."""
    gate = date_gate(F.col("api_source"), F.col("raw_date"), F.col("published"), wall_clock(settings.cutoff))
    return described.filter(gate).drop("raw_date", "published")


def normalize(items: DataFrame, settings: Settings) -> DataFrame:
    """Articles out of raw items with ord, title, url, seendate, api_source and reasoning."""
    return admit(describe(items, settings), settings)
