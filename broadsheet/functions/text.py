"""Text expressions. All are built-in Spark expressions and stay inside generated code."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.fixed_values import WHITESPACE, WHITESPACE_CLASS


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body names it.

    Long expressions stay small this way: spelled out, a chain of patterns that is named twice at
    each of several levels outgrows what one generated method can hold.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim every kind of Unicode whitespace; plain ``trim`` only knows the space."""
    return F.btrim(text, F.lit(WHITESPACE))


def has_two_words(text: Column) -> Column:
    return text.rlike(f"[^{WHITESPACE_CLASS}][{WHITESPACE_CLASS}]+[^{WHITESPACE_CLASS}]")


def title_key(title: Column) -> Column:
    """Letters and digits of the lower-cased title before the first ``-`` or ``|``."""
    return F.regexp_replace(F.lower(title), r"(?s)[-|].*|[^a-z0-9]", "")


def strip_ordinals(text: Column) -> Column:
    """``21st`` becomes ``21``."""
    return F.regexp_replace(text, r"(\d+)(?:st|nd|rd|th)", "$1")


def repair_ampersands(xml: Column) -> Column:
    """Escape each ``&`` that does not start one of the five named XML entities."""
    return F.regexp_replace(xml, r"&(?!(?:amp|lt|gt|quot|apos);)", "&amp;")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Case-insensitive substring test for any of the words."""
    upper = F.upper(text)
    hit = F.lit(False)
    for word in words:
        hit = hit | upper.contains(word.upper())
    return hit


def title_words(title: Column) -> Column:
    """Distinct lower-case letter-digit words of a title, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(title), F.lit(r"([a-z0-9]+)"), F.lit(1))))


def is_yes(answer: Column) -> Column:
    return F.upper(strip(answer)) == "YES"


def fenced_block(reply: Column) -> Column:
    """The JSON text of a reply: the first fenced block if there is one, else the reply.

    A block opened as json wins over a plain one that starts earlier.
    """
    inside_json = F.regexp_extract(reply, r"(?s)```json\s*(.*?)\s*```", 1)
    inside_plain = F.regexp_extract(reply, r"(?s)```\s*(.*?)\s*```", 1)
    return (
        F.when(reply.contains("```json"), inside_json)
        .when(reply.contains("```"), inside_plain)
        .otherwise(reply)
    )
