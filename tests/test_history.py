"""Deduplication across runs, and look-ups with repeated keys."""

import uuid

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import history, lookup
from broadsheet.operators.dedup import dedup_greedy
from broadsheet.sources.articles import landed_articles
from tests.conftest import SMALL

ROWS = "ord LONG, url STRING, title STRING"


@pytest.fixture
def keys(spark, tmp_path):
    name = f"keys_{uuid.uuid4().hex}"
    yield history.KeptKeys(spark, name, str(tmp_path / "keys"), buckets=4)
    spark.sql(f"DROP TABLE {name}")


def ords(df):
    return sorted(row["ord"] for row in df.collect())


def test_runs_equal_one_walk(spark, keys):
    feed = landed_articles(spark, SMALL).select("ord", "url", "title")
    parts = [feed.filter(F.col("ord").between(low, low + 49)) for low in range(0, 200, 50)]
    kept = [history.run_daily(part, keys, f"day {i}") for i, part in enumerate(parts)]
    assert sorted(sum(map(ords, kept), [])) == ords(dedup_greedy(feed))


def test_dropped_rows_claim_no_keys(spark, keys):
    first = spark.createDataFrame([(1, "u1", "title one"), (2, "u1", "title two")], ROWS)
    second = spark.createDataFrame(
        [(3, "u1?x", "title three"), (4, "u4", "Title Two"), (5, "u5", "title three"), (6, "u6", "!!"), (7, "u7", "!!"), (8, "u8", "title one")],
        ROWS,
    )
    assert ords(history.run_daily(first, keys, "a")) == [1]
    assert ords(history.run_daily(second, keys, "b")) == [4, 5, 6, 7]


def test_a_run_tried_again(spark, keys):
    feed = landed_articles(spark, SMALL).select("ord", "url", "title")
    history.run_daily(feed.filter("ord < 100"), keys, "a")
    once = ords(history.run_daily(feed.filter("ord >= 100"), keys, "b"))
    table = sorted(map(tuple, spark.table(keys.name).collect()))
    assert ords(history.run_daily(feed.filter("ord >= 100"), keys, "b")) == once
    assert sorted(map(tuple, spark.table(keys.name).collect())) == table
    # An earlier run does not see the keys of a later one.
    assert ords(history.dedup_new(feed.filter("ord < 100"), keys, "a")) == ords(dedup_greedy(feed.filter("ord < 100")))


def test_declared_again(spark, keys, tmp_path):
    """Another session finds the runs that are there."""
    rows = spark.createDataFrame([(1, "u1", "title one")], ROWS)
    history.run_daily(rows, keys, "a")
    other = history.KeptKeys(spark, f"again_{uuid.uuid4().hex}", str(tmp_path / "keys"), buckets=4)
    assert other.before("b").count() == 2
    spark.sql(f"DROP TABLE {other.name}")


def test_empty_run(spark, keys):
    assert ords(history.run_daily(spark.createDataFrame([], ROWS), keys, "a")) == []


def test_history_is_not_shuffled(spark, keys):
    rows = landed_articles(spark, SMALL).select("ord", "url", "title")
    history.run_daily(rows, keys, "a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        wanted = spark.createDataFrame([(b"x" * 16,)], "key BINARY")
        text = keys.before("b").join(wanted, "key", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "SelectedBucketsCount: 4 out of 4" in scan and "PartitionFilters: [isnotnull(run" in scan
    # Only the new keys are exchanged, into as many parts as there are buckets.
    assert text.count("Exchange hashpartitioning") == 1


REPEATED = [("a.org", 3, 5), ("a.org", 1, 2), ("a.org", None, 1), ("b.org", 4, 1), ("b.org", 4, 1), (None, 9, 0)]


def test_one_tier_per_article(spark):
    articles = spark.createDataFrame([(i, d) for i, d in enumerate(["a.org", "b.org", "c.org", None])], "ord LONG, domain STRING")
    with_order = spark.createDataFrame(REPEATED, "domain STRING, tier INT, ord LONG")
    found = {row["ord"]: row["tier"] for row in lookup.lookup_tier(articles, with_order, 7).collect()}
    assert found == {0: 7, 1: 4, 2: 7, 3: 7}  # the first row of a.org has no tier
    without = with_order.drop("ord")
    found = {row["ord"]: row["tier"] for row in lookup.lookup_tier(articles, without, 7).collect()}
    assert found == {0: 1, 1: 4, 2: 7, 3: 7}


def test_one_target_per_link(spark):
    links = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "url STRING")
    targets = spark.createDataFrame([("x", "late", 9), ("x", "early", 1), ("x", "early", 1)], "src_url STRING, final_url STRING, ord LONG")
    assert sorted(str(row["url"]) for row in lookup.resolve_urls(links, targets).collect()) == ["None", "early", "early", "y"]


def test_one_rendering_per_page(spark):
    pages = spark.createDataFrame([("x", "short"), ("y", None), ("z", "l" * 400)], "url STRING, content STRING")
    other = spark.createDataFrame([("x", "bb"), ("x", "aa"), ("x", None), ("y", None), ("z", "zz")], "url STRING, content STRING")
    found = {row["url"]: row["content"] for row in lookup.fallback_content(pages, other).collect()}
    assert found == {"x": "aa", "y": None, "z": "l" * 400}
