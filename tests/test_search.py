"""Search strings and the positional index."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.filters import near, phrase
from broadsheet.operators.positions import PositionIndex
from broadsheet.operators.search_string import SearchStringError, search_column
from tests.conftest import SMALL
from tests.test_plans import executions

AS_OF = datetime(2024, 1, 31)
ROWS = [
    (0, "The United States met China today", "state.gov", AS_OF - timedelta(days=1)),
    (1, "US and much else, then China", "news.reuters.com", AS_OF - timedelta(days=20)),
    (2, "United States only", "gov.cn", AS_OF - timedelta(days=2)),
    (3, "Sino-American talks (China) of the U.S.-China kind", "example.com", None),
    (4, "CHINA united the states", "notreuters.com", AS_OF),
    (5, None, None, None),
    (6, "or and a bare OR", "foo.gov", AS_OF),
]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ROWS, "id INT, text STRING, domain STRING, published TIMESTAMP_NTZ")


def found(articles, search):
    column = search_column(search, F.col("text"), F.col("domain"), F.col("published"), AS_OF)
    return [row["id"] for row in articles.filter(column).orderBy("id").collect()]


@pytest.mark.parametrize(
    "search, ids",
    [
        ('"United States" "China"', [0]),
        ('"United States" "China" (domain:gov OR domain:gov.cn OR domain:reuters.com)', [0]),
        ("China (site:gov OR site:reuters.com) when:10d", [0]),
        ("China (site:gov OR site:reuters.com) when:30d", [0, 1]),
        ('(near20:"United States China" OR near20:"US China" OR "U.S.-China" OR "Sino-American")', [0, 1, 3, 4]),
        ('(near3:"United States China" OR near3:"US China") (domain:state.gov)', [0]),
        ('near3:"United States China"', [0, 4]),
        ("china -domain:gov -domain:reuters.com", [3, 4]),
        # OR binds its neighbours: (united) and (only or today).
        ("united only OR today", [0, 2]),
        ("(united only) OR talks", [2, 3]),
        ("united AND -(china OR only)", []),
        ("-(china)", [2, 5, 6]),
        ("--china", [0, 1, 3, 4]),
        ('"or"', [6]),
        ("ORbit OR met", [0]),
        ("domain:reuters.com", [1]),
        ("  china   today  ", [0]),
    ],
)
def test_searches(articles, search, ids):
    assert found(articles, search) == ids


@pytest.mark.parametrize(
    "search, position",
    [
        ("", 0), ("()", 1), ("(a OR b", 0), ("a)", 1), ("a OR", 4), ("OR a", 0), ('a "b', 2), ('""', 0), ('near5:"one"', 0),
        ("when:soon", 0), ("a (b (c) d", 2), ("a AND", 5), ("a - b", 0),
    ],
)
def test_errors(search, position):
    if search == "a - b":
        search_column(search, F.col("text"))  # a lone dash is a word
        return
    with pytest.raises(SearchStringError) as error:
        search_column(search, F.col("text"), published=F.col("p"), as_of=AS_OF)
    assert error.value.position == position


def test_missing_columns():
    for search in ("domain:gov", "when:3d"):
        with pytest.raises(SearchStringError):
            search_column(search, F.col("text"))


def ids(df):
    return sorted(row["doc"] for row in df.collect())


WORDS = ["a", "ab", "abc", "b", "bc", "é", "中", "x1"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    """Random texts with all kinds of gaps, one word in all of them, in two batches."""
    rng = random.Random(5)
    rows = [(i, "hot " + "".join(rng.choice(WORDS).upper() + rng.choice([" ", " ", " ", "  ", ", ", "\n", "-"]) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, " . "), (303, "a " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    index = PositionIndex(spark, str(tmp_path_factory.mktemp("index")), buckets=4)
    index.append(docs.filter("doc_id < 100"), 0)
    index.append(docs.filter("doc_id >= 100"), 1)
    return docs, index, rows


@pytest.mark.parametrize("terms, distance", [(["a", "b"], 1), (["hot", "X1"], 3), (["abc", "é", "中"], 4), (["a", "nowhere"], 9), (["a"], 0), (["a", "A", "b"], 2)])
def test_near_equals_the_scan(indexed, terms, distance):
    docs, index, _ = indexed
    want = docs.filter(near(F.col("text"), terms, distance)).select(F.col("doc_id").cast("string").alias("doc"))
    assert ids(index.near(terms, distance)) == ids(want)


@pytest.mark.parametrize("words", ["a", "b", "bc", "a b", "B AB", "ab a b", "a a a", "nowhere", "c 中", "é é", "hot a"])
def test_phrase_equals_the_scan(indexed, words):
    docs, index, rows = indexed
    assert ids(index.phrase(words)) == ids(docs.filter(phrase(F.col("text"), words)).select(F.col("doc_id").cast("string").alias("doc")))
    assert ids(index.phrase(words)) == sorted(str(i) for i, text in rows if text and words.lower() in text.lower())


def test_a_batch_appended_again(spark, indexed):
    docs, index, _ = indexed
    before = sorted(map(str, index.postings().collect()))
    index.append(docs.filter("doc_id >= 100"), 1)
    assert sorted(map(str, index.postings().collect())) == before
    assert index.docs().count() == docs.count()


def test_no_text_is_read(indexed):
    _, index, _ = indexed
    for df in (index.near(["a", "b"], 3), index.phrase("a b")):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "text" not in re.sub(r"(?i)context", "", text)
    scan = index.near(["a", "b"], 3)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", scan) and re.search(r"PushedFilters: \[[^\]]*In\(word", scan)


def test_other_phrases_are_refused(indexed):
    _, index, _ = indexed
    for words in ("U.S.", "a  b", "", "a-b"):
        with pytest.raises(ValueError):
            index.phrase(words)


def test_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    index = PositionIndex(spark, str(tmp_path / "index"))
    index.append(docs, 0)
    for words in ("worthless", "que la", "from the"):
        want = docs.filter(phrase(F.col("text"), words)).select(F.col("doc_id").cast("string").alias("doc"))
        assert ids(index.phrase(words)) == ids(want)


def test_documents_are_indexed_without_a_shuffle(spark, indexed, tmp_path):
    """Postings are written by the task that read the documents, and phrases look words up without a join."""
    docs, index, _ = indexed
    before = max(executions(spark))
    PositionIndex(spark, str(tmp_path / "index")).append(docs, 0)
    written = [e.physicalPlanDescription() for number, e in executions(spark).items() if number > before]
    postings = [text for text in written if "/postings/batch=0" in text and "MapInArrow" in text]
    assert len(postings) == 1 and "Exchange" not in postings[0]
    assert "Join" not in index.phrase("a b")._jdf.queryExecution().executedPlan().toString()


def test_a_document_landed_twice(spark, tmp_path):
    index = PositionIndex(spark, str(tmp_path / "index"), buckets=2)
    rows = [(1, "one two three"), (1, "one two three"), (2, "two  one")]
    index.append(spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3), 0)
    assert ids(index.near(["one", "two"], 1)) == ["1", "2"] and ids(index.near(["one", "three"], 2)) == ["1"]
