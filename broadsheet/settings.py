"""One frozen bundle of run parameters, handed to the operators that need them."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from broadsheet import fixed_values as fixed


@dataclass(frozen=True)
class RelevanceRule:
    """A keyword that speaks for (weight > 0) or against (weight < 0) an item."""

    keyword: str
    weight: int
    category: str


# Default weights; the categories are those of the relevance question, the numbers are ours.
RELEVANCE_RULES = (
    RelevanceRule("summit", 2, "state action"),
    RelevanceRule("readout", 2, "state action"),
    RelevanceRule("sanction", 3, "policy shift"),
    RelevanceRule("export control", 3, "policy shift"),
    RelevanceRule("tariff", 2, "policy shift"),
    RelevanceRule("combat patrol", 3, "military"),
    RelevanceRule("nuclear", 2, "military"),
    RelevanceRule("semiconductor", 2, "technology"),
    RelevanceRule("smuggling", 2, "technology"),
    RelevanceRule("critical mineral", 2, "decoupling"),
    RelevanceRule("supply chain", 1, "decoupling"),
    RelevanceRule("opinion", -3, "opinion"),
    RelevanceRule("analysis", -2, "opinion"),
    RelevanceRule("might", -1, "speculation"),
    RelevanceRule("earnings", -2, "market"),
    RelevanceRule("tourism", -3, "noise"),
    RelevanceRule("culture", -2, "noise"),
)


@dataclass(frozen=True)
class Settings:
    """Run parameters. ``as_of`` is the run time; no operator reads the clock.

    Every cap and text cut defaults to None, so nothing is left out; ``REPORT_CAPS`` has the
    figures of an interactive report, for ``settings.with_(**REPORT_CAPS)``.
    """

    as_of: datetime
    lookback_days: int = 7
    tiers: dict[str, int] = field(default_factory=lambda: dict(fixed.SOURCE_TIERS))
    default_tier: int = 1
    feed_keywords: tuple[str, ...] = fixed.FEED_KEYWORDS
    line_keywords: tuple[str, ...] = fixed.LINE_KEYWORDS
    enabled_sources: tuple[str, ...] = fixed.SOURCES
    save_source_lists: bool = True
    relevance_rules: tuple[RelevanceRule, ...] = RELEVANCE_RULES
    relevance_threshold: int = 2
    relevance_cap: int | None = None
    triage_cap: int | None = None
    final_cap: int | None = None
    search_results_per_query: int | None = None
    gdelt_records: int | None = None
    google_news_items: int | None = None
    min_page_chars: int = 300
    max_page_lines: int | None = None
    max_page_chars: int | None = None

    @property
    def allowed_domains(self) -> tuple[str, ...]:
        return tuple(self.tiers)

    @property
    def cutoff(self) -> datetime:
        return self.as_of - timedelta(days=self.lookback_days)

    def with_(self, **changes) -> Settings:
        return replace(self, **changes)


REPORT_CAPS = {
    "relevance_cap": 300,
    "triage_cap": 150,
    "final_cap": 250,
    "search_results_per_query": 50,
    "gdelt_records": 250,
    "google_news_items": 250,
    "max_page_lines": 1_000,
    "max_page_chars": 25_000,
}
