"""Index pages with the markup that regular expressions get wrong easily."""

from datetime import datetime

from pyspark.sql import functions as F

from broadsheet.functions import html
from broadsheet.operators import pages
from broadsheet.settings import Settings

SETTINGS = Settings(as_of=datetime(2026, 5, 28, 12, 0))
PAGE = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style>
<script>var a = "<a href='/no'>no</a><!-- ";</script></head><body>
<!-- <a href="/hidden">hidden</a> -->
<p>Plain <b>bold</b> &lt;tag&gt; &#8364; &#x4e2d; &copy; &unknown; a&b
<A class="x>y" HREF='/one'> Trade  <i>talks</i> &amp; more </A><time datetime="z"> May 27, 2026 </time>
<a href="//cdn.gov/two">US-China two</a> <time></time>
<a href=three.html>three words here</a><a href="/empty"><img src="i.png"></a><a name="n">anchor only</a>
<a href="https://x.gov/a?b=1&amp;c=2">four&nbsp;words</a> May 26, 2026
</body></html>"""
URL = "https://www.state.gov/list/index.html?q=1"


def text_of(spark, page, times=True):
    df = spark.createDataFrame([(page, URL)], "html STRING, url STRING")
    return df.select(html.page_text(F.col("html"), F.col("url"), times)).first()[0]


def test_page_text(spark):
    assert text_of(spark, PAGE).split("\n") == [
        "T & U",
        "Plain",
        "bold",
        "<tag> € 中 © &unknown; a&b",
        "[Tradetalks& more](https://www.state.gov/one)",
        "(Date: May 27, 2026)",
        "[US-China two](https://cdn.gov/two)",
        "[three words here](three.html)",
        "anchor only",
        "[four\xa0words](https://x.gov/a?b=1&c=2)",
        "May 26, 2026",
    ]
    assert "(Date:" not in text_of(spark, PAGE, times=False)
    assert "May 27, 2026" in text_of(spark, PAGE, times=False).split("\n")


def test_links(spark):
    df = spark.createDataFrame([(1, PAGE, URL)], "page_id BIGINT, html STRING, url STRING")
    rows = pages.extract_links(df).orderBy("pos").collect()
    assert [(r.pos, r.text, r.href) for r in rows] == [
        (0, "Tradetalks& more", "https://www.state.gov/one"),
        (1, "US-China two", "https://cdn.gov/two"),
        (2, "three words here", "three.html"),
        (3, "four\xa0words", "https://x.gov/a?b=1&c=2"),
    ]


def test_kept_lines(spark):
    lines = [
        "short",
        "May 28, 2026",
        "Updated at 10:00",
        "May 28, 2026: a long line that carries the date of the run itself",
        "x" * 41,
        "x" * 40,
        "2026/5/1",
        "Sept 9",
        "tariffs on chips",
        "[a](b)",
        "![i](j) [ ](k)",
        "![i](j) us-based",
        "  ",
    ]
    df = spark.createDataFrame([("\n".join(lines),)], "content STRING")
    kept = df.select(pages.kept_lines(F.col("content"), SETTINGS)).first()[0]
    assert kept == [lines[3], lines[4], lines[6], lines[7], lines[8], lines[9], "us-based"]
    capped = df.select(pages.kept_lines(F.col("content"), SETTINGS.with_(max_page_lines=2))).first()[0]
    assert capped == [lines[3], lines[4]]


def test_harvest_never_guesses_a_date(spark):
    content = "\n".join(
        [
            "[First long title](https://www.state.gov/1)",
            "(Date: May 27, 2026)",
            "[Second long title](https://www.state.gov/2)",
            "[Third title on May 26, 2026](https://www.state.gov/3)",
            "[Fourth title](https://www.state.gov/2026/05/25/4)",
            "[Single](https://www.state.gov/2026/05/25/5)",
            "[Sixth title, too old](https://www.state.gov/2026/01/25/6)",
        ]
    )
    df = spark.createDataFrame([(7, content)], "page_id BIGINT, content STRING")
    rows = pages.harvest(df, SETTINGS).orderBy("pos").collect()
    assert [(r.title, r.date) for r in rows] == [
        ("First long title", "May 27, 2026"),
        ("Third title on May 26, 2026", "May 26, 2026"),
        ("Fourth title", ""),
    ]


def test_collection_with_fallback(spark):
    link = '<a href="/n/{0}?u=1">Report number {0}</a><time>May 27, 2026</time>'
    table = spark.createDataFrame(
        [
            (0, "https://www.state.gov/list", "<p>" + "".join(link.format(i) for i in range(12)) + link.format(3) + "</p>"),
            (1, "https://www.dhs.gov/list", "<p>short</p>"),
            (2, "https://www.fbi.gov/list", "<p>short</p>"),
        ],
        "page_id BIGINT, url STRING, html STRING",
    )
    other = spark.createDataFrame(
        [("https://www.dhs.gov/list", "[Report of DHS](https://www.dhs.gov/n/1)\nMay 26, 2026")], "url STRING, content STRING"
    )
    found = pages.collect_pages(table, SETTINGS, alternatives=other).orderBy("ord").collect()
    assert [r.title for r in found] == [f"Report number {i}" for i in range(12)] + ["Report of DHS"]
    assert {r.api_source for r in found} == {"official_scrape"}
    assert found[-1].seendate == "20260526"


def test_times_with_markup_inside(spark):
    page = (
        '<p>a</p><time class="x"><span>May</span> <b>27</b>, 2026</time><a href="/b"> Two words </a>'
        "<TIME>&nbsp;<i> </i></TIME><time>June\n1, 2026</time >tail<time>open"
    )
    lines = text_of(spark, page).split("\n")
    assert lines[:2] == ["a", "(Date: May27, 2026)"] and lines[2].startswith("[Two words](")
    assert "(Date: June" in lines and "tail" in lines and "open" in lines
    assert sum(line.startswith("(Date:") for line in lines) == 2


def test_harvester_in_place_of_the_rules(spark):
    def harvester(contents):
        return contents.select(
            "page_id", F.lit(0).alias("pos"), F.lit("Two words").alias("title"), F.lit("https://state.gov/x").alias("url"),
            F.lit("May 27, 2026").alias("date"), F.lit("said so").alias("reasoning"),
        )

    table = spark.createDataFrame([(1, "https://state.gov/", PAGE)], "page_id BIGINT, url STRING, html STRING")
    found = pages.collect_pages(table, SETTINGS, harvester=harvester).collect()
    assert [(r.title, r.seendate, r.reasoning) for r in found] == [("Two words", "20260527", "said so")]
