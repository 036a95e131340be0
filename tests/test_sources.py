"""Readers over landed files, with broken items among them."""

import json
from datetime import datetime

import pytest

from broadsheet.operators.dedup import dedup_greedy
from broadsheet.operators.normalize import normalize
from broadsheet.settings import Settings
from broadsheet.sources import landing, reference

SETTINGS = Settings(as_of=datetime(2026, 5, 28, 12, 0))


def land(folder, payloads):
    for number, payload in enumerate(payloads):
        part = folder / f"payload_no={number}"
        part.mkdir(parents=True)
        (part / "payload.txt").write_text(payload, encoding="utf-8")
    return str(folder)


def test_gdelt(spark, tmp_path):
    articles = [
        {"url": "https://www.state.gov/a", "title": "Two words", "seendate": "20260526T101500Z", "tone": "-1.5"},
        {"url": "https://www.state.gov/b", "title": "Old news", "seendate": "20260101T101500Z"},
        {"url": "https://www.state.gov/art/2026/05/27/c", "title": "On the hour", "seendate": "20260101T100000Z"},
        {"url": "https://other.com/d", "title": "Wrong domain", "seendate": "20260526T101500Z"},
        {"title": "No url at all"},
    ]
    path = land(tmp_path / "gdelt", [json.dumps({"articles": articles}), "not json", "{}"])
    items = landing.read_gdelt(spark, path, SETTINGS)
    assert items.count() == 5
    rows = normalize(items, SETTINGS).orderBy("ord").collect()
    assert [(r.title, r.domain, r.seendate, r.tier) for r in rows] == [
        ("Two words", "state.gov", "20260526", 1),
        ("On the hour", "state.gov", "20260527", 1),
    ]
    assert landing.read_gdelt(spark, path, SETTINGS.with_(gdelt_records=2)).count() == 2


def test_plain_files_are_told_apart(spark, tmp_path):
    """Files in one folder, in name order; of two copies of an article the dedup keeps one."""
    folder = tmp_path / "plain folder"
    folder.mkdir()
    article = {"url": "https://www.state.gov/a", "title": "Two words", "seendate": "20260526T101500Z"}
    for name in ("b +%41.json", "a.json", "c é.json"):
        other = {"url": f"https://www.state.gov/{ord(name[0])}", "title": f"Other {name[0]}", "seendate": "20260526T101500Z"}
        (folder / name).write_text(json.dumps({"articles": [article, other]}), encoding="utf-8")
    items = landing.read_gdelt(spark, str(folder), SETTINGS)
    rows = items.orderBy("ord").collect()
    assert len({r.ord for r in rows}) == 6 and [r.title for r in rows[1::2]] == ["Other a", "Other b", "Other c"]
    kept = dedup_greedy(normalize(items, SETTINGS)).collect()
    assert sorted(r.title for r in kept) == ["Other a", "Other b", "Other c", "Two words"]


def test_several_files_under_one_number(spark, tmp_path):
    path = land(tmp_path / "gdelt", ["{}", "{}"])
    (tmp_path / "gdelt" / "payload_no=1" / "more.txt").write_text("{}")
    with pytest.raises(ValueError, match="payload_no=1"):
        landing.read_gdelt(spark, path, SETTINGS)


def test_search(spark, tmp_path):
    one = {"results": [{"title": "A b", "url": "https://reuters.com/1", "published_date": "Wed, 27 May 2026 10:00:01 GMT", "content": "x"}]}
    two = {"results": [{"title": "C d", "url": "https://reuters.com/2", "published_date": None, "content": None, "score": 0.5}]}
    path = land(tmp_path / "search", [json.dumps(one), json.dumps(two)])
    items = landing.read_search(spark, path, SETTINGS).orderBy("ord").collect()
    assert [(r.title, r.reasoning) for r in items] == [("A b", "x"), ("C d", None)]
    assert items[0].ord < items[1].ord
    kept = normalize(landing.read_search(spark, path, SETTINGS), SETTINGS).collect()
    assert [(r.title, r.seendate, r.reasoning) for r in kept] == [("A b", "20260527", "x")]


FEED = """<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>
<item><title>China & US talks</title><link>https://www.fmprc.gov.cn/art/2026/5/27/a.html</link>
<description><![CDATA[<p>Text</p>]]></description><dc:creator>x</dc:creator></item>
<item><title>Broken <b>China</title><link>https://x</link></item>
<item><title>Nothing relevant</title><link>https://example.com/1</link></item>
<item><title>Trade with China</title><link>https://ustr.gov/2</link><pubDate>1779796800000</pubDate></item>
<item><title>China &amp; mail date</title><link>https://ustr.gov/3</link><pubDate>Wed, 27 May 2026 10:00:01 GMT</pubDate></item>
<item><title>China without link</title><link></link></item>
<item><title>关税 news</title><link>https://ustr.gov/4</link><description>d</description></item>
</channel></rss>"""


def test_rss(spark, tmp_path):
    items = landing.read_rss(spark, land(tmp_path / "rss", [FEED]), SETTINGS).orderBy("ord").collect()
    assert [(r.title, r.seendate) for r in items] == [
        ("China & US talks", "20260527T000000Z"),
        ("Trade with China", "20260526T120000Z"),
        ("China & mail date", ""),
        ("关税 news", ""),
    ]
    assert items[0].reasoning == "<p>Text</p>"


def test_google_news(spark, tmp_path):
    links = spark.createDataFrame(
        [("https://www.fmprc.gov.cn/art/2026/5/27/a.html", "https://reuters.com/2026/05/26/story")], "src_url STRING, final_url STRING"
    )
    path = land(tmp_path / "gnews", [FEED])
    items = landing.read_google_news(spark, path, SETTINGS, links).orderBy("ord").collect()
    assert (items[0].url, items[0].seendate) == ("https://reuters.com/2026/05/26/story", "20260526")
    assert {r.url: r.seendate for r in items}["https://ustr.gov/3"] == "20260527"
    assert landing.read_google_news(spark, path, SETTINGS.with_(google_news_items=1)).count() == 1


def test_atom(spark, tmp_path):
    atom = (
        "<feed xmlns='http://www.w3.org/2005/Atom'><lastBuildDate>L</lastBuildDate>"
        "<entry><title type='html'>One</title><published>P</published></entry>"
        "<entry><title>Two</title></entry><entry><pubDate>Q</pubDate><published>P</published></entry></feed>"
    )
    rows = landing.read_atom(spark, land(tmp_path / "atom", [atom])).orderBy("pos").collect()
    assert [(r.title, r.date) for r in rows] == [("One", "P"), ("Two", "L"), (None, "Q")]


def test_order_is_checked(spark):
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(landing.item_order(0, F.lit(0), F.lit(1 << 24))).collect()


def test_reference_lists(spark):
    assert reference.tier_table(spark).count() == 40
    pages = reference.page_table(spark)
    assert pages.filter("api_source = 'chinese_state_media'").count() == 3
    assert pages.count() == 36
    assert reference.feed_table(spark).count() == 6
    assert reference.keyword_table(spark).filter("kind = 'feed'").count() == 18


def test_google_news_gate(spark):
    """The aggregator may come without a date or domain, but not with an old date."""
    rows = [
        (1, "No date", "https://news.google.com/x", "", "google_news"),
        (2, "Odd date", "https://news.google.com/x", "lately", "google_news"),
        (3, "Old date", "https://news.google.com/x", "20260101", "google_news"),
        (4, "Other source", "https://news.google.com/x", "20260527", "gdelt"),
        (5, "State media", "https://unknown.cn/2026/05/27/x", "", "chinese_state_media"),
        (6, "State media", "https://unknown.cn/x", "", "chinese_state_media"),
        (7, "Old url", "https://news.google.com/2020/01/01/x", "", "google_news"),
    ]
    df = spark.createDataFrame(
        [(*row, None) for row in rows], "ord BIGINT, title STRING, url STRING, seendate STRING, api_source STRING, reasoning STRING"
    )
    kept = {r.ord: r.seendate for r in normalize(df, SETTINGS).collect()}
    assert kept == {1: "00000000", 2: "00000000", 5: "20260527", 7: "20200101"}
