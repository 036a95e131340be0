"""The whole digest and its stand-alone listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet import fixed_values as fixed
from broadsheet.functions.dates import display_date
from broadsheet.functions.urls import canonical_url
from broadsheet.operators import dedup, relevance, sinks, triage
from broadsheet.operators.filters import filter_lookback
from broadsheet.operators.lookup import lookup_tier
from broadsheet.operators.normalize import normalize
from broadsheet.operators.rank import first_per_group, number_top, top
from broadsheet.operators.validate import DateExtractor, validate_dates
from broadsheet.settings import Settings
from broadsheet.sources.landing import enabled
from broadsheet.storage import Workspace


def curate(raw: DataFrame, settings: Settings) -> DataFrame:
    """Raw items of all sources to distinct articles."""
    work = Workspace(raw.sparkSession, "articles")
    # Both branches of the dedup read the articles; written once, the parsing is done once.
    articles = work.write(normalize(enabled(raw, settings), settings))
    return dedup.dedup_greedy(articles)


def short_list(raw: DataFrame, settings: Settings) -> DataFrame:
    """Distinct articles of the window, day by day, ranked, capped and numbered, no scoring."""
    unique = curate(raw, settings)
    dated = unique.withColumn("pub_date", F.to_date("seendate", "yyyyMMdd")).filter(F.col("seendate") != fixed.UNKNOWN_DATE)
    recent = filter_lookback(dated, "pub_date", settings.as_of, settings.lookback_days, grain="day")
    listed = number_top(recent, settings.final_cap)
    return listed.select("idx", "title", display_date(F.col("seendate")).alias("date"), "url")


def run_digest(
    raw: DataFrame,
    settings: Settings,
    scorer: relevance.Scorer | None = None,
    extractor: DateExtractor | None = None,
) -> dict[str, DataFrame]:
    """The stages of a digest by name: received, unique, pre_filtered, raw (relevant), final.

    Stages that several others read are tables in the checkpoint folder; the rest is lazy.
    """
    work = Workspace(raw.sparkSession, "digest")
    # The articles and the keys that stay are tables already; a copy of both is not made.
    unique = curate(raw, settings)
    dated = work.write(validate_dates(unique, settings, extractor))
    scorer = scorer or relevance.rule_scorer(settings)
    relevant = work.write(relevance.score_relevance(dated, scorer, settings.relevance_cap))
    retained = triage.triage(relevant, settings.triage_cap)
    return {
        "received": raw,
        "unique": unique,
        "pre_filtered": dated,
        "raw": relevant,
        "final": top(retained, settings.final_cap),
    }


def publish_digest(stages: dict[str, DataFrame], settings: Settings, path: str) -> None:
    """Write the three published lists of a digest."""
    run_ts = settings.as_of.strftime("%Y%m%d_%H%M%S")
    for stage in ("pre_filtered", "raw"):
        sinks.publish(stages[stage], path, stage, run_ts, enabled=settings.save_source_lists)
    sinks.publish(stages["final"], path, "final", run_ts, cap=settings.final_cap)


def listing(articles: DataFrame, tiers: DataFrame, default_tier: int = fixed.LISTING_DEFAULT_TIER) -> DataFrame:
    """The stand-alone listing over a labelled union (ord, api_source, url, domain, title, …).

    Allowed domains are those of the tier table, exact match; the first row of each canonical url
    stays, all columns are kept, and tier and a printed label are added. Rows come in tier order,
    then in their own, by a range-partitioned sort.
    """
    allowed = tiers.select(F.col("domain").alias("_allowed"))
    items = articles.filter(F.col("url") != "").join(allowed, F.col("domain") == F.col("_allowed"), "left_semi")
    keyed = items.withColumn("_canon", canonical_url(F.col("url")))
    unique = first_per_group(keyed, ["_canon"], [F.col("ord").asc()]).drop("_canon")
    tiered = lookup_tier(unique, tiers, default_tier)
    tone = F.coalesce(F.col("tone").try_cast("double"), F.lit(0.0))
    label = F.format_string(
        "[T%d] [%s] [%+.1f] [%s] %s", "tier", F.coalesce("sourcecountry", F.lit("")), tone, "api_source", "title"
    )
    return tiered.withColumn("label", label).orderBy("tier", "ord")
