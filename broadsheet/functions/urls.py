"""Url expressions. ``parse_url`` rejects urls that feeds do contain, so these are patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions.text import bind

_LEADING_CONTROL = "".join(map(chr, range(0x21)))
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"


def clean_url(url: Column) -> Column:
    """Drop tabs and line breaks anywhere, control characters and spaces in front."""
    return F.ltrim(F.translate(url, "\t\r\n", ""), F.lit(_LEADING_CONTROL))


def url_domain(url: Column) -> Column:
    """Authority part, each ``www.`` removed, lower case; port and user stay."""
    authority = F.regexp_extract(clean_url(url), rf"^(?:{_SCHEME})?//([^/?#]*)", 1)
    return F.lower(F.replace(authority, F.lit("www."), F.lit("")))


def canonical_url(url: Column) -> Column:
    """Url without query and fragment and with a lower-case scheme."""
    clean = clean_url(url)
    base = F.regexp_replace(clean, r"(?s)[?#].*$", "")
    # Rare: capitals in the scheme, or an empty parameter (a bare `;`) at the end of the path.
    rare = clean.rlike(r"^[^:/?#]*[A-Z][^:/?#]*:|;(?:[?#]|$)")
    trimmed = F.regexp_replace(base, r"^((?:.*/)?[^/;]*);$", "$1")
    scheme = F.regexp_extract(base, rf"^{_SCHEME}", 0)
    return F.when(rare, F.concat(F.lower(scheme), F.substr(trimmed, F.length(scheme) + 1))).otherwise(base)


def domain_suffixes(domain: Column) -> Column:
    """``a.b.c`` gives ``[a.b.c, b.c, c]``: suffix membership becomes equality."""
    return bind(
        F.split(domain, r"\."),
        lambda labels: F.transform(
            labels, lambda _, at: F.array_join(F.slice(labels, at + 1, F.size(labels)), ".")
        ),
    )


def domain_matches(domain: Column, allowed) -> Column:
    """True if the domain equals an allowed one or is below it; for lists of bounded size."""
    alternatives = "|".join(name.replace(".", r"\.") for name in sorted(allowed))
    if not alternatives:
        return F.lit(False)
    return domain.rlike(rf"^(?:.*\.)?(?:{alternatives})$")


def absolute_url(href: Column, page_url: Column) -> Column:
    """Resolve hrefs that start with ``/`` against the page; others stay as they are."""
    scheme = F.regexp_extract(page_url, rf"^({_SCHEME})", 1)
    origin = F.regexp_extract(page_url, rf"^({_SCHEME}//[^/?#]*)", 1)
    return (
        F.when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(href)
    )


def url_path_date(url: Column) -> Column:
    """``/art/2026/5/11/`` as ``20260511T000000Z``; NULL where the path has no such part."""
    pattern = r"/art/(\d{4})/(\d{1,2})/(\d{1,2})/"
    year, month, day = (F.regexp_extract(url, pattern, i) for i in (1, 2, 3))
    return F.when(year != "", F.concat(year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"), F.lit("T000000Z")))
