"""Filters on domain, time, keywords, phrases and word distance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.dates import wall_clock
from broadsheet.functions.text import contains_any
from broadsheet.functions.urls import domain_matches, domain_suffixes


def filter_nonempty(df: DataFrame, *columns: str) -> DataFrame:
    for name in columns:
        df = df.filter(F.col(name) != "")
    return df


def filter_domains(df: DataFrame, allowed: Sequence[str] | DataFrame, column: str = "domain") -> DataFrame:
    """Rows whose domain is allowed or lies below an allowed one.

    A configured list becomes one pattern test. A table of any size (``domain`` column) is matched
    on the distinct domains: their suffixes make it an equality join, and the matching domains
    then select the rows; both joins are left to the optimizer's size checks.
    """
    if not isinstance(allowed, DataFrame):
        return df.filter(domain_matches(F.col(column), allowed))
    names = df.select(F.col(column).alias("_name")).distinct()
    suffixes = names.select("_name", F.explode(domain_suffixes(F.col("_name"))).alias("_suffix"))
    matching = suffixes.join(allowed.select(F.col("domain").alias("_suffix")), "_suffix", "left_semi")
    return df.join(matching.select("_name").distinct(), F.col(column) == F.col("_name"), "left_semi")


def filter_exact_domains(df: DataFrame, allowed: DataFrame, column: str = "domain") -> DataFrame:
    """Rows whose domain is in the table as it stands."""
    return df.join(allowed.select(F.col("domain").alias("_allowed")), F.col(column) == F.col("_allowed"), "left_semi")


def within_lookback(moment: Column, as_of: datetime, days: int, grain: str = "second") -> Column:
    """True from ``days`` before the run time on; there is no upper bound, NULL is outside.

    ``grain='day'`` compares calendar days, which lets in the whole first day.
    """
    return F.coalesce(_since(moment, as_of, days, grain), F.lit(False))


def _since(moment: Column, as_of: datetime, days: int, grain: str) -> Column:
    cutoff = as_of - timedelta(days=days)
    # A moment lies on or after a day exactly if it is not before that day's midnight.
    return moment >= (F.lit(cutoff.date()) if grain == "day" else wall_clock(cutoff))


def filter_lookback(df: DataFrame, column: str, as_of: datetime, days: int, grain: str = "second") -> DataFrame:
    """Rows inside the window; a bare comparison, which the scan can take over."""
    return df.filter(_since(F.col(column), as_of, days, grain))


def filter_keywords(df: DataFrame, keywords: Sequence[str], columns: Sequence[str] = ("title", "url")) -> DataFrame:
    """Rows with any keyword as a substring of any of the columns, case ignored."""
    hit = F.lit(False)
    for name in columns:
        hit = hit | contains_any(F.col(name), keywords)
    return df.filter(hit)


def phrase(text: Column, words: str) -> Column:
    """Whether a text holds the phrase, case ignored. Combines with ``near`` by ``&``, ``|`` and ``~``."""
    return F.coalesce(F.lower(text).contains(words.lower()), F.lit(False))


def search(
    df: DataFrame,
    text: str,
    all_phrases: Sequence[str] = (),
    any_phrases: Sequence[str] = (),
    domains: Sequence[str] = (),
    domain: str = "domain",
) -> DataFrame:
    """``"A" "B" ("C" OR "D") (domain:x OR domain:y)``: all of the first, one of each other kind."""
    if domains:
        df = df.filter(domain_matches(F.col(domain), domains))
    for words in all_phrases:
        df = df.filter(phrase(F.col(text), words))
    if any_phrases:
        df = df.filter(contains_any(F.col(text), any_phrases))
    return df


def near(text: Column, terms: Sequence[str], distance: int = 20) -> Column:
    """Whether all terms occur within ``distance`` words of each other, anywhere in the text.

    Words are runs of letters and digits, case ignored. A substring test decides most rows. The
    rest is read once per row: the words that are terms, in order, each updating the last position
    of its term; a row matches when the last positions lie close enough at some word. The work per
    row is linear in its length and nothing is exploded or shuffled.
    """
    wanted = list(dict.fromkeys(term.lower() for term in terms))
    lower = F.lower(text)
    possible = F.lit(True)
    for term in wanted:
        possible = possible & lower.contains(term)
    words = F.regexp_extract_all(lower, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    placed = F.transform(words, lambda word, at: F.struct(word.alias("word"), at.alias("at")))
    hits = F.filter(placed, lambda hit: hit["word"].isin(*wanted))
    return F.coalesce(F.when(possible, all_close(hits, wanted, distance)), F.lit(False))


def all_close(hits: Column, wanted: Sequence[str], distance: int) -> Column:
    """Whether ``hits``, an array of structs of ``word`` and ``at`` in the order of ``at``, has all wanted words within the distance."""

    def start() -> Column:
        unseen = [F.lit(None).cast("int").alias(f"t{i}") for i in range(len(wanted))]
        return F.struct(*unseen, F.lit(False).alias("near"))

    def step(seen: Column, hit: Column) -> Column:
        last = [F.when(hit["word"] == term, hit["at"]).otherwise(seen[f"t{i}"]) for i, term in enumerate(wanted)]
        # array_min skips NULL, the position of a term that has not occurred yet.
        span = F.array_max(F.array(*last)) - F.array_min(F.array(*last))
        complete = F.forall(F.array(*last), lambda position: position.isNotNull())
        close = seen["near"] | F.coalesce(complete & (span <= distance), F.lit(False))
        return F.struct(*(position.alias(f"t{i}") for i, position in enumerate(last)), close.alias("near"))

    return F.aggregate(hits, start(), step, lambda seen: seen["near"])


def search_near(df: DataFrame, text: str, terms: Sequence[str], distance: int = 20) -> DataFrame:
    """Rows in which all terms occur within ``distance`` words of each other."""
    return df.filter(near(F.col(text), terms, distance))
