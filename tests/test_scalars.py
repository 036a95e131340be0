"""Edge rows of the scalar expressions."""

import random
from datetime import date, datetime
from email.utils import parsedate_to_datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import dates, text, urls

AS_OF = datetime(2026, 5, 28, 12, 0)

DATES = [
    ("Wed, 27 May 2026 23:30:00 -0500", "", "2026-05-27"),
    ("27 May 2026 10:11:12 GMT", "", "2026-05-27"),
    ("May 21, 2026 10:00 AM", "", "2026-05-21"),
    ("Thu, 21 May 26 10:00:00 GMT", "", "2026-05-21"),
    ("21 May 69 10:00:00 GMT", "", "1969-05-21"),
    ("Thu May 21 10:00:01 2026", "", "2026-05-21"),
    ("Thu May 21 10:00:01 UTC 2026", "", "2026-05-21"),
    ("Thursday, 21-May-26 10:00:01 GMT", "", "2026-05-21"),
    ("20260511T101500Z", "", "2026-05-11"),
    ("20260511T100000Z", "https://a.gov/x", None),
    ("20260511T100000Z", "https://a.gov/art/2026/5/11/c_1.htm", "2026-05-11"),
    ("2026-05-11T10:00:00Z", "", "2026-05-11"),
    ("May 21, 2026", "", "2026-05-21"),
    ("21 May 2026", "", "2026-05-21"),
    ("21st May 2026", "", None),
    ("Sep 5, 2026", "", None),
    ("May 9, 2026 - 10 AM", "", "2026-05-09"),
    ("May 21 2026", "", "2026-05-21"),
    ("May 21", "", "2026-05-21"),
    ("May 30", "", "2026-05-30"),
    ("May 31", "", "2025-05-31"),
    ("31 December", "", "2025-12-31"),
    ("February 29", "", None),
    ("29 February 2024", "", "2024-02-29"),
    ("2026/5/1", "", "2026-05-01"),
    ("2026-02-31", "", None),
    ("2026-02-31", "https://a.gov/2026/03/01/x", "2026-03-01"),
    ("", "https://ustr.gov/about/2026/may/11/x", "2026-05-11"),
    ("", "https://ustr.gov/about/2026/may/", "2026-05-01"),
    ("", "https://ustr.gov/about/2026/May/45/", None),
    ("", "https://ustr.gov/about/2026/foo/11/", None),
    ("", "https://a.gov/20260511/x", "2026-05-11"),
    ("", "https://a.gov/2026/13/45/20260511/", "2026-05-11"),
    ("Unknown", "https://r.com/summit-2026-04-30/", "2026-04-30"),
    ("", "https://r.com/a-2026-04-30", "2026-04-30"),
    ("", "https://r.com/a-2026-04-31/2026/04/02", None),
    ("", "https://a.gov/0000/05/11/x", None),
    ("", "https://s.com/article/3261051/x", None),
    (None, "https://r.com/a-2026-04-30", "2026-04-30"),
    (None, None, None),
]


def test_dates(spark):
    rows = [(i, t, u) for i, (t, u, _) in enumerate(DATES)]
    df = spark.createDataFrame(rows, "i int, t string, u string")
    got = df.select("i", dates.parse_date(F.col("t"), F.col("u"), AS_OF).cast("date").cast("string")).collect()
    assert {i: d for i, d in got} == {i: d for i, (_, _, d) in enumerate(DATES)}


def test_mail_dates_follow_the_standard_library(spark):
    """Random token orders; what the library reads, the expression must read alike."""
    rng = random.Random(7)
    pick = rng.choice
    samples = set()
    while len(samples) < 1500:
        day, year = str(rng.randint(1, 33)), pick(["2026", "1999", "26", "68", "69", "7"])
        month = pick(["May", "may", "Sep", "Sept", "September", "FEB", "Xyz"])
        clock = pick(["10:11:12", "7:05", "23:59:60", "24:00:00", "9.05.07", "10:11.12", "1011"])
        zone = pick(["GMT", "+0800", "-0500", "", "AM", "(CET)"])
        order = pick(
            [
                f"{day} {month} {year} {clock} {zone}",
                f"{month} {day}, {year} {clock} {zone}",
                f"{month} {day} {clock} {year}",
                f"{month} {day} {clock} {zone or 'UTC'} {year}",
                f"{day}-{month}-{year} {clock} {zone}",
                f"{day}, {month} {year} {clock}",
                f"{day} {month} {year}",
                f"{day} {month} {year} {clock}+0100",
            ]
        )
        samples.add(pick(["", "", "Wed, ", "Wed ", "Wed,", "Wednesday, "]) + order.strip())
    samples = sorted(samples)

    def expected(sample):
        try:
            return parsedate_to_datetime(sample).replace(tzinfo=None)
        except (ValueError, TypeError, IndexError, OverflowError):
            return None

    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = {s: d for s, d in df.select("s", dates.mail_timestamp(F.col("s"))).collect()}
    wrong = [(s, got[s], expected(s)) for s in samples if got[s] != expected(s)]
    assert not wrong, (len(wrong), wrong[:20])
    assert sum(d is not None for d in got.values()) > 300


@pytest.mark.parametrize(
    "url, domain, canonical",
    [
        ("HTTP://WWW.State.gov/a;p=1?x#y", "www.state.gov", "http://WWW.State.gov/a;p=1"),
        ("https://user@www.state.gov:8080/a#b?c", "user@state.gov:8080", "https://user@www.state.gov:8080/a"),
        ("english.www.gov.cn/x?y", "", "english.www.gov.cn/x"),
        ("//a.gov/x", "a.gov", "//a.gov/x"),
        ("https://a.gov?x=1", "a.gov", "https://a.gov"),
        ("https://a.gov/a b?c", "a.gov", "https://a.gov/a b"),
        ("https://english.www.gov.cn/x/", "english.gov.cn", "https://english.www.gov.cn/x/"),
        ("  https://a.gov/x\n#y", "a.gov", "https://a.gov/x"),
        ("https://a.gov/x;?q", "a.gov", "https://a.gov/x"),
    ],
)
def test_urls(spark, url, domain, canonical):
    df = spark.createDataFrame([(url,)], "u string")
    row = df.select(urls.url_domain(F.col("u")), urls.canonical_url(F.col("u"))).first()
    assert tuple(row) == (domain, canonical)


def test_titles_and_words(spark):
    df = spark.createDataFrame(
        [("Hello-World | X", "hello"), ("A | B - C", "a"), ("US-China talks", "us"), ("中美会谈", ""), ("a\nb - c", "ab")],
        "t string, k string",
    )
    assert df.filter(text.title_key(F.col("t")) != F.col("k")).count() == 0
    words = spark.createDataFrame(
        [("one two", True), ("one", False), (" one ", False), ("one　two", True), ("", False)], "t string, w boolean"
    )
    assert words.filter(text.has_two_words(F.col("t")) != F.col("w")).count() == 0
    assert spark.createDataFrame([("　 x\t\n",)], "t string").select(text.strip(F.col("t"))).first()[0] == "x"


def test_domain_matching(spark):
    df = spark.createDataFrame(
        [("state.gov", True), ("www2.state.gov", True), ("estate.gov", False), ("gov", False), ("stateXgov", False)],
        "d string, m boolean",
    )
    assert df.filter(urls.domain_matches(F.col("d"), ["state.gov", "gov.cn"]) != F.col("m")).count() == 0
    assert df.select(urls.domain_suffixes(F.lit("a.b.c"))).first()[0] == ["a.b.c", "b.c", "c"]


def test_rendering_of_dates(spark):
    df = spark.createDataFrame([("20260511", "2026-05-11"), ("x", "x"), ("20260511T", "20260511T")], "s string, d string")
    assert df.filter(dates.display_date(F.col("s")) != F.col("d")).count() == 0
    row = df.select(
        dates.millis_stamp(F.lit("1748433600000")),
        dates.millis_stamp(F.lit("12x")),
        dates.seendate(F.lit(None).cast("timestamp_ntz")),
        dates.seendate(F.lit(date(2026, 5, 1))),
        dates.mail_or_raw(F.lit("Wed, 27 May 2026 23:30:00 -0500")),
        dates.mail_or_raw(F.lit("yesterday")),
        urls.url_path_date(F.lit("http://x/art/2026/5/1/a.htm")),
    ).first()
    assert tuple(row) == ("20250528T120000Z", None, "00000000", "20260501", "20260527", "yesterday", "20260501T000000Z")
