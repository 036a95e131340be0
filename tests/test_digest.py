"""Stages, sinks, numbering, scorers and the stream."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import rank, relevance, sinks, validate
from broadsheet.operators.filters import search_near
from broadsheet.operators.normalize import normalize
from broadsheet.plans import catalog, digest
from broadsheet.settings import Settings
from broadsheet.sources.articles import FEED_SETTINGS, landed_articles, landed_stream
from broadsheet.streaming import landing_stream
from tests.conftest import SMALL

ARTICLES = "ord BIGINT, title STRING, url STRING, domain STRING, seendate STRING, api_source STRING, tier INT, reasoning STRING"


def articles(spark, n):
    rows = [
        (i, f"title {i}", f"https://x/{i}", "x", "00000000" if i % 5 == 0 else f"202401{i % 28 + 1:02d}", "gdelt", i % 3, "r")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, ARTICLES)


def in_order(rows):
    return sorted(rows, key=lambda r: (r.tier, -int(r.seendate), r.ord))


def test_numbering_of_the_whole_list(spark):
    df = articles(spark, 500).repartition(7)
    numbered = {r.idx: r.ord for r in rank.number_rows(df).collect()}
    assert numbered == {i: r.ord for i, r in enumerate(in_order(df.collect()), 1)}
    assert rank.number_rows(df.limit(0)).count() == 0


def test_published_lists(spark, tmp_path):
    out = str(tmp_path / "out")
    df = articles(spark, 40)
    sinks.publish(df, out, "pre_filtered", "20240131_120000")
    sinks.publish(df, out, "final", "20240131_120000", cap=10)
    sinks.publish(df.limit(0), out, "raw", "20240131_120000")
    sinks.publish(df, out, "raw", "20240201_120000", enabled=False)
    lists = spark.read.parquet(f"{out}/lists")
    assert {(r.stage, r["count"]) for r in lists.groupBy("stage").count().collect()} == {("pre_filtered", 40), ("final", 10)}
    sinks.publish(df.limit(3), out, "pre_filtered", "20240202_120000")
    assert spark.read.parquet(f"{out}/latest").count() == 3
    with pytest.raises(ValueError):
        sinks.publish(df, out, "other", "x")


def test_publishing_again_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    for n in (40, 40, 25):
        sinks.publish(articles(spark, n), out, "pre_filtered", "20240131_120000")
        sinks.publish(articles(spark, n), out, "final", "20240131_120000", cap=10)
        for path in (f"{out}/lists/run_ts=20240131_120000/stage=pre_filtered", f"{out}/latest"):
            assert sorted(r.idx for r in spark.read.parquet(path).collect()) == list(range(1, n + 1))
        assert spark.read.parquet(f"{out}/lists/run_ts=20240131_120000/stage=final").count() == 10


def test_numbering_without_a_cap_is_distributed(spark):
    numbered = rank.number_top(articles(spark, 300).repartition(5), None)
    assert sorted(r.idx for r in numbered.collect()) == list(range(1, 301))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


def test_final_list_of_nothing_is_written(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.publish(articles(spark, 0), out, "final", "20240131_120000", cap=10)
    assert spark.read.parquet(f"{out}/lists/run_ts=20240131_120000/stage=final").count() == 0


def test_printed_lines(spark, tmp_path):
    out = str(tmp_path / "text")
    df = rank.number_top(articles(spark, 30), 4)
    sinks.publish_text(df, out)
    best = in_order(articles(spark, 30).collect())[:4]
    expected = []
    for i, r in enumerate(best, 1):
        shown = f"{r.seendate[:4]}-{r.seendate[4:6]}-{r.seendate[6:]}"
        expected += [f"{i}. {r.title}", f"Date: {shown}", f"Source: {r.url}", ""]
    parts = sorted((tmp_path / "text").glob("part-*"))
    assert "".join(part.read_text() for part in parts).split("\n")[:-1] == expected


def test_digest_is_published(spark, tmp_path):
    stages = digest.run_digest(landed_articles(spark, SMALL), FEED_SETTINGS)
    digest.publish_digest(stages, FEED_SETTINGS, str(tmp_path / "out"))
    lists = spark.read.parquet(str(tmp_path / "out" / "lists"))
    counts = {r.stage: r["count"] for r in lists.groupBy("stage").count().collect()}
    assert set(counts) == {"pre_filtered", "raw", "final"}
    assert counts["final"] <= counts["raw"] <= counts["pre_filtered"]


SETTINGS = Settings(as_of=datetime(2026, 5, 28, 12, 0))
VALIDATION = [
    # ord, seendate, url, source, snippet, expected date or reason
    (1, "20260521", "https://x/1", "gdelt", "", date(2026, 5, 21)),
    (2, "20260520", "https://x/2", "gdelt", "", "old"),
    (3, "00000000", "https://x/3", "gdelt", "said on 25 May 2026 that", date(2026, 5, 25)),
    (4, "00000000", "https://x/4", "gdelt", "no date", "unverifiable"),
    (5, "20260527", "https://x/5", "google_news", "no date", "unverifiable"),
    (6, "20260527", "https://x/6", "google_news", "on 2026-05-26 or 2026-05-01", date(2026, 5, 26)),
    (7, "20260527", "https://x/2026/05/26/7", "google_news", "", date(2026, 5, 27)),
    (8, "00000000", "https://x/2026/05/26/8", "google_news", "", date(2026, 5, 26)),
    (9, None, "https://x/9", "rss", "x" * 5000 + " May 24, 2026", date(2026, 5, 24)),
]


def validation_rows(spark):
    rows = [(o, "a title", u, "x", d, s, 1, text) for o, d, u, s, text, _ in VALIDATION]
    return spark.createDataFrame(rows, ARTICLES)


def test_final_dates(spark):
    judged = validate.judge_dates(validation_rows(spark), SETTINGS).collect()
    got = {r.ord: r.drop_reason or r.pub_date for r in judged}
    assert got == {row[0]: row[5] for row in VALIDATION}
    kept = validate.validate_dates(validation_rows(spark), SETTINGS).collect()
    assert {r.ord: r.seendate for r in kept} == {
        row[0]: row[5].strftime("%Y%m%d") for row in VALIDATION if isinstance(row[5], date)
    }


def test_own_extractor_sees_untrusted_rows_only(spark):
    seen = []

    def extractor(df):
        seen.append(sorted(r.ord for r in df.collect()))
        return df.withColumn("date_str", F.lit("2026-05-23"))

    kept = validate.validate_dates(validation_rows(spark), SETTINGS, extractor)
    assert {r.ord: r.seendate for r in kept.collect()}[4] == "20260523"
    assert seen == [[3, 4, 5, 6, 9]]


def test_model_scorer(spark):
    examples = spark.createDataFrame(
        [("sanctions on chips", 1.0), ("tariff talks resume", 1.0), ("cooking with garlic", 0.0), ("garden tips today", 0.0)] * 5,
        "text STRING, label DOUBLE",
    )
    model = relevance.fit_relevance_model(examples, features=1 << 10)
    rows = [
        (1, "sanctions again", "u", "d", "20240101", "gdelt", 1, "chips"),
        (2, "garlic and garden", "u", "d", "20240101", "gdelt", 1, "cooking"),
    ]
    kept = relevance.score_relevance(spark.createDataFrame(rows, ARTICLES), relevance.model_scorer(model))
    assert [r.ord for r in kept.collect()] == [1]
    assert kept.columns == [part.split()[0] for part in ARTICLES.split(", ")]


def test_relevance_cap_comes_first(spark):
    asked = []

    def scorer(df):
        asked.append(df.count())
        return df.withColumn("is_relevant", F.lit(" yes "))

    assert relevance.score_relevance(articles(spark, 50), scorer, cap=7).count() == 7
    assert asked == [7]


def test_words_near_each_other(spark):
    rows = [
        (1, "alpha " + "x " * 19 + "beta", True),
        (2, "alpha " + "x " * 20 + "beta", False),
        (3, "Beta,ALPHA", True),
        (4, "alphabet beta", False),
        (5, "alpha " + "x " * 5000 + "beta alpha", True),
        (6, "alpha", False),
    ]
    df = spark.createDataFrame(rows, "id INT, text STRING, near BOOLEAN")
    found = {r.id for r in search_near(df, "text", ["alpha", "beta"], 20).collect()}
    assert found == {id_ for id_, _, near in rows if near}


def test_stream_in_pieces_equals_batch(spark, tmp_path):
    source = tmp_path / "docs"
    spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").repartitionByRange(4, "doc_id").write.parquet(str(source))
    raw = landed_stream(spark, str(source), "*.parquet").drop("day")
    table = str(tmp_path / "articles")
    query = landing_stream.land_articles(raw, FEED_SETTINGS, table, str(tmp_path / "progress"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    window = landing_stream.landed_window(spark, table, FEED_SETTINGS)
    batch = normalize(landed_articles(spark, SMALL), FEED_SETTINGS)
    assert sorted(map(tuple, window.collect())) == sorted(map(tuple, batch.collect()))
    # A later window over the same table is that of a later batch run.
    later = FEED_SETTINGS.with_(as_of=FEED_SETTINGS.as_of + timedelta(days=3))
    assert {r.ord for r in landing_stream.landed_window(spark, table, later).collect()} == {
        r.ord for r in normalize(landed_articles(spark, SMALL), later).collect()
    }


def test_stream_files_follow_the_table(spark, tmp_path):
    """As many files as the table has partitions, in a fixed number of triggers."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.repartition(24).write.parquet(str(tmp_path / "documents.parquet"))
    own = spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()
    files = str(tmp_path / "landed")
    per_trigger = catalog._landed_files(spark, str(tmp_path), files)
    assert len(spark.read.parquet(files).inputFiles()) == own > 4 and per_trigger == -(-own // 4) > 1
    raw = landed_stream(spark, files, "*.parquet", per_trigger).drop("day")
    query = landing_stream.land_articles(raw, FEED_SETTINGS, str(tmp_path / "articles"), str(tmp_path / "progress"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == -(-own // per_trigger) > 1
    window = landing_stream.landed_window(spark, str(tmp_path / "articles"), FEED_SETTINGS)
    assert {r.ord for r in window.collect()} == {r.ord for r in normalize(landed_articles(spark, SMALL), FEED_SETTINGS).collect()}
    # One file of one row group still makes several files.
    assert catalog._landed_files(spark, SMALL, str(tmp_path / "small")) == 1
    assert len(spark.read.parquet(str(tmp_path / "small")).inputFiles()) == 4


def test_stream_across_the_turn_of_the_year(spark, tmp_path):
    """Dates without a year are read as of each item's arrival."""
    rows = [(1, "2025-12-30 08:00:00"), (2, "2026-01-16 08:00:00")]
    for ord_, arrived in rows:
        item = (ord_, "Two words", f"https://state.gov/{ord_}", "January 15", "gdelt", "", datetime.fromisoformat(arrived))
        frame = spark.createDataFrame([item], "ord BIGINT, title STRING, url STRING, seendate STRING, api_source STRING, reasoning STRING, arrived TIMESTAMP_NTZ")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    table = str(tmp_path / "table")
    landing_stream.land_articles(raw, FEED_SETTINGS, table, str(tmp_path / "progress")).awaitTermination()
    landed = {r.ord: r.seendate for r in spark.read.parquet(table).selectExpr("ord", "CAST(seendate AS STRING) AS seendate").collect()}
    assert landed == {1: "20250115", 2: "20260115"}
    window = landing_stream.landed_window(spark, table, FEED_SETTINGS.with_(as_of=datetime(2026, 1, 17)))
    assert [r.ord for r in window.collect()] == [2]


def test_common_words_are_not_shuffled(spark, monkeypatch):
    """The items' common words are summed in place, rare and unseen ones are counted; scores are those of plain counts."""
    from math import log

    monkeypatch.setattr(relevance, "COMMON", 10)
    examples = [("aa aa aa aa bb", 1), ("aa bb bb cc dd", 0), ("aa ee", 1)]
    model = relevance.fit_word_model(spark.createDataFrame(examples, "text STRING, label INT"))
    assert sorted(row["word"] for row in model.ratios.filter("common").collect()) == ["aa", "bb"]
    items = [(1, "aa Aa cc zz zz"), (2, "bb"), (3, None), (4, "zz"), (5, "cc"), (5, "dd dd")]
    scored = relevance.word_scores(spark.createDataFrame(items, "ord LONG, text STRING"), model)
    yes, no = {"aa": 5, "bb": 1, "ee": 1}, {"aa": 1, "bb": 2, "cc": 1, "dd": 1}
    ratio = lambda word: log((yes.get(word, 0) + 1) / (7 + 5 + 1)) - log((no.get(word, 0) + 1) / (5 + 5 + 1))
    want = {1: "aa aa cc zz zz", 2: "bb", 3: "", 4: "zz", 5: "cc dd dd"}
    for row in scored.collect():
        words = want[row["ord"]].split()
        mean = sum(map(ratio, words)) / len(words) if words else 0.0
        assert abs(row["score"] - (mean * 10 + log(3 / 2))) < 1e-9
    assert scored.count() == len(items)
    text = scored._jdf.queryExecution().executedPlan().toString()
    # Read upwards: the items meet the common words before their first shuffle.
    assert "BroadcastHashJoin" in text and text.rindex("BroadcastHashJoin") > text.index("HashAggregate")


def test_a_whole_list_moves_its_texts_once(spark, tmp_path):
    """Keys that repeat or are null keep their places, parts and all; the texts are no table before they are published."""
    rows = [(i // 3 if i % 50 else None, f"t{i}", "u", "x", f"202401{i % 2 + 10}", "gdelt", i % 3 or None, "r" * 100) for i in range(3000)]
    df = spark.createDataFrame(rows, "ord LONG, title STRING, url STRING, domain STRING, seendate STRING, api_source STRING, tier INT, reasoning STRING").repartition(5)
    numbered = rank.number_wide(df, rows_least=100)
    assert numbered.rdd.getNumPartitions() > 3
    found = sorted(numbered.collect(), key=lambda r: r.idx)
    assert [r.idx for r in found] == list(range(1, 3001)) and sorted(r.title for r in found) == sorted(r[1] for r in rows)
    low = lambda value: (value is not None, value or 0)
    keys = [(low(r.tier), -int(r.seendate), low(r.ord)) for r in found]
    assert keys == sorted(keys)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    # The shuffle of this test's own rows, and one more.
    assert plan.split("Initial Plan")[-1].count("Exchange") == 2 and "ranking" not in plan
