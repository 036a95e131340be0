"""Greedy two-key dedup against a sequential walk."""

import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import dedup


def walk(rows):
    urls, titles, kept = set(), set(), []
    for ord_, url, title in sorted(rows):
        if url in urls or (title is not None and title in titles):
            continue
        urls.add(url)
        if title is not None:
            titles.add(title)
        kept.append(ord_)
    return kept


def kept(spark, rows, partitions=4):
    df = spark.createDataFrame(rows, "ord BIGINT, first STRING, second STRING").repartition(partitions)
    return sorted(row.ord for row in dedup.greedy_keys(df).collect())


def random_rows(seed, n, urls, titles):
    rng = random.Random(seed)
    return [
        (i, f"u{rng.randrange(urls)}", None if rng.random() < 0.1 else f"t{rng.randrange(titles)}") for i in range(n)
    ]


CASES = {
    "sparse": random_rows(1, 400, 300, 300),
    "dense": random_rows(2, 400, 60, 60),
    # A third of all rows share one title, another third one url.
    "hot": [(i, "hot" if i % 3 == 0 else f"u{i % 97}", "hot" if i % 3 == 1 else f"t{i % 89}") for i in range(600)],
    "copies": [(i, f"u{i % 3}", f"t{i % 3}") for i in range(300)],
    # Keys alternate along one chain: each round decides one link only.
    "chain": [(i, f"u{i // 2}", f"t{(i + 1) // 2}") for i in range(24)],
    # Half of all rows have no title key, a third of the rest share one.
    "half_null": [(i, f"u{i % 211}", None if i % 2 else "hot" if i % 3 == 0 else f"t{i % 83}") for i in range(600)],
    "no_titles": [(i, f"u{i % 7}", None) for i in range(50)],
}


@pytest.mark.parametrize("name", CASES)
def test_default(spark, name):
    assert kept(spark, CASES[name]) == walk(CASES[name])


def test_partitioning_does_not_matter(spark):
    rows = CASES["dense"]
    assert kept(spark, rows, partitions=1) == kept(spark, rows, partitions=13) == walk(rows)


def test_empty(spark):
    assert kept(spark, []) == []


def test_chain_of_three(spark):
    """A dropped row does not claim its other key."""
    rows = [(1, "http://a/1", "One two"), (2, "http://a/2", "One two"), (3, "http://a/2?x=1", "Three four"), (4, "", "x y")]
    df = spark.createDataFrame(rows, "ord BIGINT, url STRING, title STRING")
    assert sorted(row.ord for row in dedup.dedup_greedy(df).collect()) == [1, 3]


def test_titles_without_letters_never_match(spark):
    rows = [(1, "http://a/1", "中美会谈"), (2, "http://a/2", "中美会谈"), (3, "http://a/1#x", "another title")]
    df = spark.createDataFrame(rows, "ord BIGINT, url STRING, title STRING")
    assert sorted(row.ord for row in dedup.dedup_greedy(df).collect()) == [1, 2]


def test_first_of_each_url(spark):
    rows = [(3, "HTTP://a/x?1"), (1, "http://a/x#2"), (2, "http://a/y")]
    df = spark.createDataFrame(rows, "ord BIGINT, url STRING")
    assert sorted(row.ord for row in dedup.dedup_first(df).collect()) == [1, 2]
    by_host = dedup.dedup_first(df, F.lit("same"), [F.col("ord").desc()])
    assert [row.ord for row in by_host.collect()] == [3]
