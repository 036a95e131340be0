"""Search strings as news services take them, turned into one filter column.

    "United States" "China" (domain:gov OR domain:reuters.com)
    (near20:"United States China" OR "US-China") -"sports" when:10d

Parts side by side must all hold; ``OR`` binds its two neighbours, closer than standing side by side; ``AND`` may be
written; ``-`` denies the part or group after it. A quoted phrase or bare word is looked for as it stands, case ignored.
``nearN:"..."`` wants all its words within N words of each other, ``domain:`` and its alias ``site:`` the domain or one
below it, ``when:Nd`` a publication in the last N days. The strings are short and written by people: this is
a reader for them, not a language; everything they say is an expression of ``operators.filters``.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.urls import domain_matches
from broadsheet.operators.filters import near, phrase, within_lookback

_TOKEN = re.compile(
    r"""\s*(?:(?P<open>\()|(?P<close>\))|(?P<deny>-(?=\S))|(?P<word_op>OR|AND)(?=[\s()]|$)"""
    r"""|(?:(?P<field>near\d+|domain|site|when):)?(?:"(?P<quoted>[^"]*)"|(?P<bare>[^\s()"]+)))"""
)


class SearchStringError(ValueError):
    """A search string that cannot be read; ``position`` is where."""

    def __init__(self, message: str, text: str, position: int):
        super().__init__(f"{message} at {position}: {text[position : position + 20]!r}")
        self.position = position


def search_column(
    search: str,
    text: Column,
    domain: Column | None = None,
    published: Column | None = None,
    as_of: datetime | None = None,
) -> Column:
    """The filter that a search string stands for. Never NULL: rows without text or domain do not match."""
    tokens = []
    at = 0
    while search[at:].strip():
        match = _TOKEN.match(search, at)
        if not match:
            raise SearchStringError("unclosed quote", search, at + len(search[at:]) - len(search[at:].lstrip()))
        tokens.append((match.lastgroup if match["quoted"] is None else "quoted", match, match.end() - len(match[0].lstrip())))
        at = match.end()
    tokens.append(("end", None, len(search)))
    place = 0

    def fail(message: str) -> None:
        raise SearchStringError(message, search, tokens[place][2])

    def leaf(match: re.Match) -> Column:
        field = match["field"]
        value = match["quoted"] if match["quoted"] is not None else match["bare"]
        if not value.strip():
            fail("nothing to look for")
        if field is None:
            return phrase(text, value)
        if field.startswith("near"):
            words = re.findall(r"[^\W_]+", value)
            if len(words) < 2:
                fail("a distance needs two words")
            return near(text, words, int(field[4:]))
        if field == "when":
            days = re.fullmatch(r"(\d+)d", value)
            if not days or published is None or as_of is None:
                fail("a time is a number of days, asked of a publication date")
            return within_lookback(published, as_of, int(days[1]))
        if domain is None:
            fail("no domain to compare")
        return F.coalesce(domain_matches(domain, [value.lower()]), F.lit(False))

    def part() -> Column:
        nonlocal place
        kind, match, _ = tokens[place]
        if kind == "deny":
            place += 1
            return ~part()
        if kind == "open":
            opened = place
            place += 1
            inner = all_of("close")
            if tokens[place][0] != "close":
                place = opened
                fail("unclosed group")
            place += 1
            return inner
        if kind not in ("quoted", "bare"):
            fail("a phrase, word or group is missing")
        found = leaf(match)
        place += 1
        return found

    def any_of() -> Column:
        nonlocal place
        found = part()
        while tokens[place][0] == "word_op" and tokens[place][1]["word_op"] == "OR":
            place += 1
            found = found | part()
        return found

    def all_of(until: str) -> Column:
        nonlocal place
        found = any_of()
        while tokens[place][0] not in (until, "end"):
            if tokens[place][0] == "close":
                fail("group was not opened")
            if tokens[place][0] == "word_op":
                place += 1
            found = found & any_of()
        return found

    return all_of("end")
