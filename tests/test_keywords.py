"""Keywords from tables against the list of conditions and against brute force."""

import random

import pytest

from broadsheet.operators.filters import filter_keywords
from broadsheet.operators.keywords import filter_keyword_table, keyword_hits
from broadsheet.settings import Settings

ITEMS = "ord BIGINT, title STRING, url STRING"


def table(spark, words):
    return spark.createDataFrame([(word,) for word in words], "keyword STRING")


def brute_force(items, words):
    words = {word.upper() for word in words if word}
    found = {}
    for row in items:
        for field, text in (("title", row[1]), ("url", row[2])):
            held = sorted(word for word in words if text and word in text.upper())
            if held:
                found[row[0], field] = held
    return found


def rows(hits):
    return {(row["ord"], row["field"]): row["keywords"] for row in hits.collect()}


@pytest.fixture(scope="module")
def items():
    choose = random.Random(7)
    letters = "aabbcéß 漢😀-"
    text = lambda longest: "".join(choose.choice(letters) for _ in range(choose.randrange(longest)))
    return [(i, text(60), text(20)) for i in range(200)] + [(200, None, "aabb"), (201, "", None), (202, None, None), (203, "Strasse", "x")]


def test_many_keywords_are_brute_force(spark, items):
    choose = random.Random(8)
    cuts = [row[1] or "ab" for row in items]
    words = [text[at : at + choose.randrange(1, 9)] for text in cuts for at in (0, 3, 7)]
    words += ["nowhere at all", "q", "STRAß", None, "", "aabb", "AABB"]
    hits = keyword_hits(spark.createDataFrame(items, ITEMS), table(spark, words))
    assert rows(hits) == brute_force(items, words)


@pytest.mark.parametrize("words", [["a"], ["aabbc"], ["漢", "b 漢"], ["nowhere"]])
def test_few_keywords(spark, items, words):
    assert rows(keyword_hits(spark.createDataFrame(items, ITEMS), table(spark, words))) == brute_force(items, words)


def test_configured_keywords_as_a_table(spark):
    words = Settings.__dataclass_fields__["feed_keywords"].default
    texts = [f"news of {word.title()} today" for word in words] + ["nothing", None, *words]
    items = spark.createDataFrame([(i, text, "https://x/" + (text or "")) for i, text in enumerate(texts)], ITEMS)
    same = lambda df: sorted(row["ord"] for row in df.collect())
    assert same(filter_keyword_table(items, table(spark, words))) == same(filter_keywords(items, words))
    assert filter_keyword_table(items, table(spark, words)).columns == items.columns


def test_nothing_to_look_for(spark, items):
    df = spark.createDataFrame(items, ITEMS)
    assert keyword_hits(df, table(spark, [None, ""])).count() == 0
    assert keyword_hits(df.limit(0), table(spark, ["a"])).count() == 0
    assert keyword_hits(df, table(spark, [])).columns == ["ord", "field", "keywords"]


def test_a_text_with_very_many_pieces(spark):
    long = "".join(f"{i:x} " for i in range(100_000))
    items = [(0, long, "u"), (1, "beef 1869f", "u")]
    words = ["1869f", "beef", "18 69", "fffff", "f f f"]
    assert rows(keyword_hits(spark.createDataFrame(items, ITEMS), table(spark, words))) == brute_force(items, words)
