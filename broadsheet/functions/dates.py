"""Publication dates out of free text and urls.

The first step that yields a date wins: mail date, numeric date, date with a month name, month
and day without a year, and last the url. All of it is built-in expressions. Each step rewrites
its match into one literal with a pattern and casts that with ``try_cast``: no parser exceptions
on the many strings that are no dates. Parts that a step names more than once are bound, so each
pattern runs once per row. Results are TIMESTAMP_NTZ, as offsets are dropped and the wall clock is
kept.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.fixed_values import MONTHS, UNKNOWN_DATE
from broadsheet.functions.text import bind, strip, strip_ordinals

_MONTH_INDEX = " ".join(month[:3] for month in MONTHS)
_MONTH = "|".join(MONTHS)
_MONTH_OR_SHORT = "|".join((*MONTHS, *(month[:3] for month in MONTHS)))
_DAY = r"3[01]|[12]\d|0[1-9]|[1-9]"


def wall_clock(moment: datetime) -> Column:
    """A zone-free literal, the same in every session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _month_number(first_three: Column) -> Column:
    """1 to 12, NULL for anything that is no month."""
    at = F.nullif(F.position(first_three, F.lit(_MONTH_INDEX)), F.lit(0))
    return F.floor((at + 3) / 4).cast("string")


def _timestamp(literal: Column) -> Column:
    """Cast ``y-m-d[ h:m:s]``; NULL for impossible dates and for year 0, which has no calendar."""
    return F.replace(literal, F.lit("0000-"), F.lit("?")).try_cast("timestamp_ntz")


def _rewrite(text: Column, pattern: str, template: str) -> Column:
    """The first match of the pattern, rewritten by the template; '' where there is none."""
    return F.regexp_replace(F.regexp_extract(text, pattern, 0), pattern, template)


def _named_month(rewritten: Column) -> Column:
    """Cast ``mmm|y-@-d ...``, where ``mmm`` names the month that ``@`` stands for."""
    return bind(
        rewritten,
        lambda parts: _timestamp(
            F.replace(F.substr(parts, F.lit(5)), F.lit("@"), _month_number(F.substring(parts, 1, 3)))
        ),
    )


def _mail_pattern() -> tuple[str, str]:
    """Pattern and template of mail dates: optional weekday, day and month in either order, year
    before or after the time, optional zone."""
    clock = r"(?<h{n}>\d+)(?<c{n}>[:.])(?<i{n}>\d+)(?:\k<c{n}>(?<s{n}>\d+))?"
    day, month, year = r"(?<d{n}>\d+)", rf"(?=(?:{_MONTH_OR_SHORT})[\s\-])(?<m{{n}}>[a-z]{{{{3}}}})[a-z]*", r"(?<y{n}>\d+)"
    # Only a clock with colons is told from a year when it comes first.
    early_clock = clock.replace("[:.]", ":")
    zone = r"(?:[-+]\S*|,?(?:\s.*)?)"
    forms = (
        rf"{day},?\s+{month}\s+{year},?\s+{clock}{zone}",
        rf"{month}\s+{day},?\s+{year},?\s+{clock}{zone}",
        rf"{day}-{month}-{year}\s+{clock}\s+\S+",
        rf"{day},?\s+{month}\s+{early_clock},?\s+(?:[^\d\s]\S*\s+)?{year}(?:\s.*)?",
        rf"{month}\s+{day},?\s+{early_clock},?\s+(?:[^\d\s]\S*\s+)?{year}(?:\s.*)?",
    )
    numbered = [form.replace("{n}", str(n)).replace("{{", "{").replace("}}", "}") for n, form in enumerate(forms)]
    every = lambda group: "".join(f"${{{group}{n}}}" for n in range(len(forms)))
    weekday = r"(?:\S*,\s*|(?:mon|tue|wed|thu|fri|sat|sun)\s+)?+"
    pattern = rf"(?s)^{weekday}(?:{'|'.join(numbered)})$"
    # An unmatched group is empty, so exactly one form fills each part.
    return pattern, f"{every('m')}|#{every('y')}#-@-{every('d')} {every('h')}:{every('i')}:0{every('s')}"


_MAIL_PATTERN, _MAIL_TEMPLATE = _mail_pattern()


def mail_timestamp(text: Column) -> Column:
    """RFC 2822 dates and their common variants, wall clock, offset ignored."""
    parts = _rewrite(F.lower(strip(text)), _MAIL_PATTERN, _MAIL_TEMPLATE)
    # Two-digit years lie between 1969 and 2068.
    parts = F.regexp_replace(parts, r"#(\d)#", "#0$1#")
    parts = F.regexp_replace(parts, r"#([0-5]\d|6[0-8])#", "20$1")
    parts = F.regexp_replace(parts, r"#(\d\d)#", "19$1")
    parts = F.regexp_replace(parts, r"#(\d{4})#", "$1")
    parts = F.regexp_replace(parts, r":0(\d\d)$", ":$1")
    return F.when(text.rlike(r"(?s)[A-Za-z]{3}.*\d[:.]\d"), _named_month(parts))


def numeric_timestamp(text: Column) -> Column:
    """The first year-month-day run, with ``-``, ``/``, a space or nothing in between."""
    return _timestamp(_rewrite(strip_ordinals(text), r"(\d{4})[-\s/]?(\d{1,2})[-\s/]?(\d{1,2})", "$1-$2-$3"))


def _month_name_parts(text: Column) -> Column:
    """``mmm|y-@-d`` for a string that is one spelled-out date, y empty where it has no year."""
    whole = strip(F.split_part(F.split_part(text, F.lit(" - "), F.lit(1)), F.lit(" | "), F.lit(1)))
    month = rf"(?=(?:{_MONTH})\b)([a-z]{{3}})[a-z]*"
    pattern = rf"^(?:{month}\s+({_DAY})(?:,?\s+(\d{{4}}))?|({_DAY})\s+{month}(?:\s+(\d{{4}}))?)$"
    return _rewrite(F.lower(whole), pattern, "$1$5|$3$6-@-$2$4")


def month_name_timestamp(text: Column, as_of: datetime | Column) -> Column:
    """``May 21, 2026``, ``21 May 2026``; without a year that of the run, or the year before if
    the date would lie more than two days ahead. The run time is a moment or, where it differs
    from row to row, a TIMESTAMP_NTZ column."""
    if isinstance(as_of, datetime):
        years = [F.lit(f"|{as_of.year - back}-") for back in (0, 1)]
        latest = wall_clock(as_of + timedelta(days=2))
    else:
        years = [F.concat(F.lit("|"), (F.year(as_of) - back).cast("string"), F.lit("-")) for back in (0, 1)]
        latest = as_of + F.expr("INTERVAL 2 DAYS")

    def dated(parts: Column, year: Column) -> Column:
        return _named_month(F.replace(parts, F.lit("|-"), year))

    def resolve(parts: Column) -> Column:
        this_year = dated(parts, years[0])
        yearless = bind(this_year, lambda day: F.when(day > latest, dated(parts, years[1])).otherwise(day))
        # A yearless date is read in a year without a leap day first, so 29 February never counts.
        return (
            F.when(parts == "feb|-@-29", None).when(parts.contains("|-"), yearless).otherwise(this_year)
        )

    return F.when(text.rlike("(?i)[a-z]{3}"), bind(_month_name_parts(text), resolve))


def date_from_text(text: Column, as_of: datetime | Column) -> Column:
    """Date of a string. Any string with ``0000`` counts as undated, on-the-hour stamps included."""

    def read(value: Column) -> Column:
        usable = (value != "") & (value != "Unknown") & ~value.contains("0000")
        steps = mail_timestamp(value), numeric_timestamp(value), month_name_timestamp(value, as_of)
        return F.when(usable, F.coalesce(*steps))

    return bind(text, read)


def date_from_url(url: Column) -> Column:
    """Date in a url path: ``/2026/05/11/`` also with dashes, ``/2026/may/11``, ``/20260511/``."""
    numbers = r"[/-](\d{4})[/-](\d{1,2})[/-](\d{1,2})"
    closed_first = rf"(?s)^(?:.*?{numbers}[/-]|.*?{numbers})"
    named = r"(?s)^(?:.*?[/-](\d{4})/([a-z]{3})[a-z]{0,6}/(\d{1,2})|.*?[/-](\d{4})/([a-z]{3})[a-z]{0,6}[/-])"

    def read(lower: Column) -> Column:
        by_name = F.regexp_replace(_rewrite(lower, named, "$2$5|$1$4-@-$3"), "-$", "-1")
        steps = (
            _timestamp(_rewrite(lower, closed_first, "$1$4-$2$5-$3$6")),
            _named_month(by_name),
            _timestamp(_rewrite(lower, r"[/-](\d{4})(\d{2})(\d{2})[/-]", "$1-$2-$3")),
        )
        # All of these dates follow a `/` or `-` with a four-digit year.
        return F.when(lower.rlike(r"[/-]\d{4}"), F.coalesce(*steps))

    return bind(F.lower(url), read)


def parse_date(text: Column, url: Column, as_of: datetime | Column) -> Column:
    """Date of the text, else of the url, as TIMESTAMP_NTZ."""
    return F.coalesce(date_from_text(text, as_of), date_from_url(url))


# Dates inside running text: the first of these forms is the date candidate.
DATE_IN_TEXT = (
    rf"(?i)\d{{4}}[-/]\d{{1,2}}[-/]\d{{1,2}}|(?:{_MONTH})\s+(?:{_DAY}),\s+\d{{4}}|(?:{_DAY})\s+(?:{_MONTH})\s+\d{{4}}"
)


def date_in_text(text: Column, as_of: datetime) -> Column:
    """The first date-like string anywhere in a text, read by the text steps."""
    return date_from_text(F.regexp_extract(text, DATE_IN_TEXT, 0), as_of)


def seendate(date: Column) -> Column:
    """``yyyyMMdd``, eight zeros for an unknown date."""
    day = F.replace(date.cast("date").cast("string"), F.lit("-"), F.lit(""))
    return F.coalesce(day, F.lit(UNKNOWN_DATE))


def display_date(stamp: Column) -> Column:
    """``yyyy-MM-dd`` for eight-character stamps, anything else unchanged."""
    dashed = F.concat_ws("-", F.substring(stamp, 1, 4), F.substring(stamp, 5, 2), F.substr(stamp, F.lit(7)))
    return F.when(F.length(stamp) == 8, dashed).otherwise(stamp)


def mail_or_raw(pub_date: Column) -> Column:
    """A feed's mail date as ``yyyyMMdd``, or the raw text if it is none."""
    day = F.replace(mail_timestamp(pub_date).cast("date").cast("string"), F.lit("-"), F.lit(""))
    return F.coalesce(day, pub_date)


def millis_stamp(text: Column) -> Column:
    """Digits-only epoch milliseconds as ``yyyyMMddTHHmmssZ`` in the session zone, else NULL."""
    moment = F.timestamp_millis(F.when(text.rlike(r"^\d+$"), text.try_cast("bigint")))
    return F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")
