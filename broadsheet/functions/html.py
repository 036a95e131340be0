"""Index pages to text, with built-in expressions.

Text nodes are separated by a marker; inside a link the marker joins instead, so that the text of
a link comes out in one piece. Markers are control characters that html text cannot contain.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.fixed_values import WHITESPACE_CLASS
from broadsheet.functions.text import bind, strip
from broadsheet.functions.urls import absolute_url

_NODE = "\x01"
_JOIN = "\x02"
_ATTRIBUTES = r"""((?:[^>"']++|"[^"]*"|'[^']*')*+)"""
_HREF = r"""(?is)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_NAMED = json.dumps({name: chr(point) for name, point in name2codepoint.items()})
_REFERENCE = r"^(#[xX][0-9a-fA-F]{1,6}|#\d{1,7}|[A-Za-z][A-Za-z0-9]*);"
# Comments, and elements whose content is no text of the page.
_SILENT = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>"


def unescape(text: Column) -> Column:
    """Decode named and numeric character references; unknown ones stay as they are."""
    # One constant, folded into a map when the plan is made.
    named = F.from_json(F.lit(_NAMED), "MAP<STRING, STRING>")

    def decode(piece: Column) -> Column:
        return bind(F.regexp_extract(piece, _REFERENCE, 1), lambda name: decode_named(piece, name))

    def decode_named(piece: Column, name: Column) -> Column:
        rest = F.substr(piece, F.length(name) + 2)
        return (
            F.when(name == "amp", F.concat(F.lit("&"), rest))
            .when(name == "", F.concat(F.lit("&"), piece))
            .when(name.startswith("#"), F.coalesce(F.concat(_numbered(name), rest), F.concat(F.lit("&"), piece)))
            .when(name == "apos", F.concat(F.lit("'"), rest))
            .otherwise(F.coalesce(F.concat(F.try_element_at(named, name), rest), F.concat(F.lit("&"), piece)))
        )

    def decode_all(pieces: Column) -> Column:
        tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), decode)
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tail, ""))

    return bind(text, lambda whole: F.when(whole.contains("&"), bind(F.split(whole, "&"), decode_all)).otherwise(whole))


def _numbered(name: Column) -> Column:
    """The character of ``#123`` or ``#x7b``, NULL for numbers that name none."""
    number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))

    def char(point: Column) -> Column:
        valid = (point > 0) & (point <= 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))

    return bind(number.try_cast("int"), char)


def keep_times(html: Column) -> Column:
    """``<time>x</time>`` becomes the text `` (Date: x) ``, markup inside it dropped and its pieces joined;
    ones without a text stay as they are."""

    def mark(piece: Column, whole: Column) -> Column:
        inner = F.regexp_replace(whole, r"(?is)^<time\b[^>]*>|</time\s*>$", "")
        inner = F.replace(F.regexp_replace(inner, f"<[^>]*>|{_NODE}", _JOIN), F.lit("&nbsp;"), F.lit(" "))
        edge = f"[{WHITESPACE_CLASS}{_JOIN}]+"
        date = F.regexp_replace(inner, f"^{edge}|{edge}$", "")
        rest = F.substr(piece, F.length(whole) + 1)
        marked = F.concat(F.lit(f"{_NODE} (Date: "), date, F.lit(f") {_NODE}"), rest)
        return F.when((whole != "") & (date != ""), marked).otherwise(piece)

    def with_whole(piece: Column) -> Column:
        return bind(F.regexp_extract(piece, r"(?is)^<time\b[^>]*>.*?</time\s*>", 0), lambda whole: mark(piece, whole))

    pieces = F.split(html, r"(?i)(?=<time\b)")
    return F.when(html.rlike(r"(?i)<time\b"), F.array_join(F.transform(pieces, with_whole), "")).otherwise(html)


def _link(piece: Column, page_url: Column) -> Column:
    """A piece that starts with a link: the link as ``[text](href)``, then the rest."""

    def rewrite(link: Column) -> Column:
        attributes = F.regexp_extract(link, rf"(?is)^<a\b{_ATTRIBUTES}>", 1)
        inner = F.regexp_extract(link, rf"(?is)^<a\b{_ATTRIBUTES}>(.*)</a\s*>$", 2)
        text = F.regexp_replace(inner, f"<[^>]*>|{_NODE}", _JOIN)
        return bind(attributes, lambda attrs: bind(text, lambda label: join(link, attrs, label)))

    def join(link: Column, attributes: Column, label: Column) -> Column:
        href = F.concat(*(F.regexp_extract(attributes, _HREF, i) for i in (1, 2, 3)))
        target = bind(href, lambda value: absolute_url(value, page_url))
        visible = strip(F.replace(F.replace(label, F.lit("&nbsp;"), F.lit(" ")), F.lit(_JOIN), F.lit(" "))) != ""
        rest = F.substr(piece, F.length(link) + 1)
        linked = F.concat(F.lit(f"{_NODE}[{_JOIN}"), label, F.lit(f"{_JOIN}]("), target, F.lit(f"){_NODE}"), rest)
        return F.when(attributes.rlike(_HREF) & visible, linked).otherwise(piece)

    whole = F.regexp_extract(piece, rf"(?is)^<a\b{_ATTRIBUTES}>.*?</a\s*>", 0)
    return bind(whole, lambda link: F.when(link == "", piece).otherwise(rewrite(link)))


def links_to_text(html: Column, page_url: Column) -> Column:
    """Each link with a text as ``[text](href)``, hrefs from the root made absolute."""
    pieces = F.split(html, r"(?i)(?=<a[\s>])")
    return F.array_join(F.transform(pieces, lambda piece: _link(piece, page_url)), "")


def page_text(html: Column, page_url: Column, times: bool = True) -> Column:
    """The text nodes of a page, trimmed, one per line; links and (optionally) times kept."""
    quiet = F.regexp_replace(html, _SILENT, _NODE)
    marked = keep_times(quiet) if times else quiet
    flat = F.regexp_replace(links_to_text(marked, page_url), r"<[^>]*>", _NODE)
    nodes = F.transform(F.split(unescape(flat), _NODE), lambda node: strip(_joined(node)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), "\n")


def _joined(node: Column) -> Column:
    """Put the parts of a link text together, without the white space between them."""
    space = f"[{WHITESPACE_CLASS}]*"
    return F.when(node.contains(_JOIN), F.regexp_replace(node, f"{space}{_JOIN}{space}", "")).otherwise(node)


def page_links(html: Column, page_url: Column) -> Column:
    """``ARRAY<STRUCT<pos, text, href>>`` of the links with a text, in page order."""
    return bind(links_to_text(F.regexp_replace(html, _SILENT, _NODE), page_url), _links)


def _links(marked: Column) -> Column:
    pattern = rf"(?s){_NODE}\[{_JOIN}(.*?){_JOIN}\]\(([^{_NODE}]*)\){_NODE}"
    texts = F.regexp_extract_all(marked, F.lit(pattern), F.lit(1))
    hrefs = F.regexp_extract_all(marked, F.lit(pattern), F.lit(2))
    return F.zip_with(
        texts,
        F.transform(hrefs, lambda href, at: F.struct(href.alias("href"), at.alias("at"))),
        lambda text, link: F.struct(
            link["at"].alias("pos"),
            strip(_joined(unescape(text))).alias("text"),
            unescape(link["href"]).alias("href"),
        ),
    )
