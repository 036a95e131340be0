"""The deduplicating stream: late rows, forgetting, restarts and state size."""

from datetime import datetime, timedelta

import pytest

from broadsheet.streaming import dedup_stream

SCHEMA = "ord LONG, url STRING, title STRING, published TIMESTAMP, note STRING"
START = datetime(2024, 1, 1)


def day(n):
    return START + timedelta(days=n)


class Feed:
    """Rows land in parts; each part is read by a stream of its own, which ends."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    def land(self, *rows):
        df = self.spark.createDataFrame([(*row, "extra") for row in rows], SCHEMA)
        df.coalesce(2).write.mode("append").parquet(f"{self.folder}/landed")
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/landed")
        query = dedup_stream.dedup_stream(stream, f"{self.folder}/kept", f"{self.folder}/progress", "10 DAYS", "5 days")
        query.awaitTermination()
        return [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]

    def kept(self):
        return sorted(row["ord"] for row in self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/kept/articles").collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def test_stream(feed):
    # In one trigger the row of lowest ord stands for its url, whatever comes first; empty urls and titles go.
    feed.land(
        (3, "https://a/x#top", "first title", day(0)), (2, "https://a/x?b=1", "other title", day(0)), (9, "https://a/x", "third title", day(1)),
        (4, "", "no url", day(0)), (5, "https://a/empty", "", day(0)), (6, "https://a/m1", "--", day(0)), (7, "https://a/m2", "--", day(0)),
    )
    assert feed.kept() == [2, 6, 7]
    # A title of an earlier trigger, under another url; the url is claimed all the same.
    feed.land((10, "https://a/y", "Other Title!", day(2)), (11, "https://a/z", "new title", day(12)))
    assert feed.kept() == [2, 6, 7, 11]
    # The watermark is at day 7: day 6 is late, day 8 is not, and url x is remembered until day 10.
    feed.land((12, "https://a/late", "late title", day(6)), (13, "https://a/ok", "fine title", day(8)), (14, "https://a/x", "x again", day(9)))
    assert feed.kept() == [2, 6, 7, 11, 13]
    # Watermark at day 20 after this one: then x has been forgotten, and so has its title.
    feed.land((15, "https://a/far", "far title", day(25)))
    feed.land((16, "https://a/x", "other title", day(24)), (17, "https://a/far?again", "far again", day(26)))
    assert feed.kept() == [2, 6, 7, 11, 13, 15, 16]


def test_state_is_bounded(feed):
    """Fifty urls a day for sixty days: the state holds those of window and lateness only."""
    sizes = []
    for part in range(6):
        rows = [(d * 50 + i, f"https://a/{d}-{i}", f"title {d}x{i}", day(d)) for d in range(part * 10, part * 10 + 10) for i in range(50)]
        states = feed.land(*rows)
        sizes.append(states[-1]["numRowsTotal"])
    assert len(feed.kept()) == 60 * 50
    assert max(sizes) <= 50 * (10 + 5 + 10 + 1) and sizes[-1] <= sizes[2]


def test_hot_url(feed):
    """A third of all rows with one url."""
    feed.land(*[(i, "https://a/hot" if i % 3 == 0 else f"https://a/{i}", f"title {i}", day(i % 5)) for i in range(3000)])
    assert feed.kept() == sorted([0, *(i for i in range(3000) if i % 3)])


def test_a_trigger_run_again(spark, tmp_path):
    """The write of a trigger replaces what an attempt before it left, in both tables."""
    names = ["ord", "url", "title", "published", "note"]
    write = dedup_stream._keep_titles(str(tmp_path), "10 DAYS", names)
    first = spark.createDataFrame([(1, "u", "one title", day(0), "")], SCHEMA)
    second = spark.createDataFrame([(2, "v", "one title", day(3), ""), (3, "w", "two title", day(3), "")], SCHEMA)
    write(first, 0)
    for _ in range(2):
        write(second, 1)
        kept = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/articles")
        assert sorted(row["ord"] for row in kept.collect()) == [1, 3]
        assert spark.read.parquet(f"{tmp_path}/titles").count() == 2
    write(spark.createDataFrame([], SCHEMA), 2)


def test_the_state_function_is_called_for_groups_of_urls(feed, monkeypatch):
    """Groups number as set, however many urls there are; each url in them is remembered and forgotten on its own."""
    monkeypatch.setattr(dedup_stream, "BUCKETS", 4)
    states = feed.land(*[(i, f"https://a/{i}", f"title {i}", day(i % 10)) for i in range(400)])
    assert max(state["numRowsTotal"] for state in states) == 4
    # The watermark is at day 4: urls of days 5 to 9 are known until days 15 to 19.
    feed.land(*[(1000 + i, f"https://a/{i}", f"again {i}", day(12)) for i in range(400)], (2000, "https://b", "far", day(21)))
    assert feed.kept() == [*range(400), 2000]
    # The watermark is at day 16: urls of days 0 to 6 are forgotten.
    feed.land(*[(3000 + i, f"https://a/{i}", f"more {i}", day(17)) for i in range(400)])
    assert feed.kept() == [*range(400), 2000, *(3000 + i for i in range(400) if i % 10 <= 6)]
