"""Final date check of articles: trusted dates at once, others from the snippet, else the url."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.fixed_values import UNKNOWN_DATE
from broadsheet.functions.dates import date_from_text, date_from_url, date_in_text, seendate
from broadsheet.functions.text import bind
from broadsheet.settings import Settings

# Adds a string column ``date_str`` to the rows whose date is not trusted.
DateExtractor = Callable[[DataFrame], DataFrame]


def judge_dates(df: DataFrame, settings: Settings, extractor: DateExtractor | None = None) -> DataFrame:
    """Add ``pub_date`` and ``drop_reason`` (NULL, 'old' or 'unverifiable').

    A known date is trusted, except an aggregator's that the url does not confirm. By default the
    first date-like string of title and whole snippet decides untrusted rows, inside the same stage. A custom extractor (a model in ``mapInPandas``, say) sees only those rows.
    """
    incoming = F.coalesce("seendate", F.lit(UNKNOWN_DATE))
    from_text = date_from_text(incoming, settings.as_of)
    from_url = date_from_url(F.col("url"))

    def known(url_date: Column) -> Column:
        """The trusted date: an aggregator's own only counts beside one in the url."""
        own = F.when((F.col("api_source") != "google_news") | url_date.isNotNull(), from_text)
        return F.coalesce(own, url_date)

    trusted = bind(from_url, known)
    if extractor is None:
        found = date_in_text(F.concat_ws("\n", "title", "reasoning"), settings.as_of)
        dated = df.withColumn("pub_date", F.coalesce(trusted, found).cast("date"))
    else:
        found = date_from_text(F.col("date_str"), settings.as_of)
        judged = df.withColumn("pub_date", trusted.cast("date"))
        unsure = extractor(judged.filter(F.col("pub_date").isNull()).drop("pub_date"))
        dated = judged.filter(F.col("pub_date").isNotNull()).unionByName(
            unsure.withColumn("pub_date", found.cast("date")).drop("date_str")
        )
    old = F.col("pub_date") < F.lit(settings.cutoff.date())
    reason = F.when(F.col("pub_date").isNull(), "unverifiable").when(old, "old")
    return dated.withColumn("drop_reason", reason)


def validate_dates(df: DataFrame, settings: Settings, extractor: DateExtractor | None = None) -> DataFrame:
    """Articles with a certain date inside the window, day by day; ``seendate`` is set to it."""
    judged = judge_dates(df, settings, extractor)
    # One mention of the date: the filter moves below the projection and repeats its expression.
    recent = judged.filter(F.col("pub_date") >= F.lit(settings.cutoff.date()))
    return recent.withColumn("seendate", seendate(F.col("pub_date"))).drop("pub_date", "drop_reason")
