"""Continuous deduplication: a stream of articles to a table without repeated urls and titles.

Urls are a keyed streaming state, in ``BUCKETS`` groups by their hash, so that the state function is called for
a group of urls and not for each. An article is kept if its canonical url was not kept within the last
``window`` of publication time; of a trigger's rows with one url the one of lowest ``ord`` stands for
them. A url is remembered until the watermark has passed its article's publication by the window,
so the state holds the urls of window and lateness, however long the stream runs. Articles published
at or before the watermark (the latest publication of earlier triggers less ``lateness``) are late and
dropped. ``dropDuplicatesWithinWatermark`` would keep any one of a trigger's rows with one url; which
one must not depend on the partitioning here, hence a state function that takes the first.

Titles are compared in ``foreachBatch`` with the table of title keys kept so far: of a trigger's rows with
one title key the first stays, unless that title was kept within ``window`` before or after its publication.
Keys are partitioned by day of publication, so only the days around the trigger's are read. Both
tables are written by trigger, and a trigger that is run again replaces what it wrote.

Copies collapse in each task before the state's shuffle, so a url that a third of all rows share is a
row per Arrow batch there. Rows without url or title go; a title without letters and digits matches none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from broadsheet.functions.text import title_key
from broadsheet.functions.urls import canonical_url
from broadsheet.storage import path_exists

# Groups of urls that the state is kept by; fixed for the life of a checkpoint.
BUCKETS = 1 << 15
KEYS = "title_key STRING, published TIMESTAMP, batch BIGINT, day DATE"


def _first_of_urls(window_ms: int, names: list[str]):
    """The state function; it travels to the tasks, which need not have this package."""

    def run(key, frames, state):
        now = state.getCurrentWatermarkMs()
        known = {url: until for url, until in zip(*state.get) if until > now} if state.exists else {}
        first = None
        if not state.hasTimedOut:
            for frame in frames:
                frame = frame[(frame["published_ms"] > now) & ~frame["canon_url"].isin(known)]
                if first is not None:
                    frame = pd.concat([first, frame])
                frame = frame.reset_index(drop=True)
                first = frame.loc[frame.groupby("canon_url", sort=False)["ord"].idxmin()]
            if first is not None and len(first):
                known |= {url: published + window_ms for url, published in zip(first["canon_url"], first["published_ms"].tolist())}
        if known:
            state.update((list(known), list(known.values())))
            # The url that is forgotten first; none of those kept is past the watermark.
            if min(known.values()) > now:
                state.setTimeoutTimestamp(min(known.values()))
        elif state.exists:
            state.remove()
        if first is not None and len(first):
            yield first[names]

    return run


def _collapse(batches: Iterator) -> Iterator:
    """Of a batch's rows with one url and publication time, the one of lowest ``ord``: rows of one url may be late or not."""
    for batch in batches:
        frame = batch.select(["canon_url", "published_ms", "ord"]).to_pandas()
        yield batch.take(frame.groupby(["canon_url", "published_ms"], sort=False)["ord"].idxmin().sort_values().tolist())


def first_urls(articles: DataFrame, window: str, lateness: str) -> DataFrame:
    """The stateful pass over a stream with ``ord``, ``url``, ``title`` and ``published`` (TIMESTAMP, not null)."""
    keyed = articles.filter((F.col("url") != "") & (F.col("title") != "")).withColumns(
        {"canon_url": canonical_url(F.col("url")), "published_ms": F.unix_millis("published")}
    )
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in keyed.schema.fields)
    window_ms = int(keyed.sparkSession.sql(f"SELECT unix_millis(timestamp_millis(0) + INTERVAL {window})").first()[0])
    # A local function: it travels to the tasks, which need not have this package.
    collapsed = keyed.mapInArrow(lambda batches: _collapse(batches), schema).withWatermark("published", lateness)
    grouped = collapsed.withColumn("_bucket", F.pmod(F.xxhash64("canon_url"), F.lit(BUCKETS))).groupBy("_bucket")
    state = "urls ARRAY<STRING>, untils ARRAY<BIGINT>"
    return grouped.applyInPandasWithState(
        _first_of_urls(window_ms, keyed.columns), schema, state, "append", GroupStateTimeout.EventTimeTimeout
    )


def _keep_titles(path: str, window: str, names: list[str]):
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # Used several times: as a table, the state is run once.
        batch.write.mode("overwrite").parquet(f"{path}/pending")
        rows = spark.read.schema(batch.schema).parquet(f"{path}/pending")
        span = rows.agg(F.min("published"), F.max("published")).first()
        if span[0] is None:
            return
        keyed = rows.withColumn("title_key", F.nullif(title_key(F.col("title")), F.lit("")))
        lead = keyed.filter("title_key IS NOT NULL").groupBy("title_key").agg(F.min("ord").alias("ord"))
        first = keyed.join(lead, ["title_key", "ord"], "left_semi")
        if path_exists(spark, f"{path}/titles"):
            gap = F.expr(f"INTERVAL {window}")
            days = F.col("day").between((F.lit(span[0]) - gap).cast("date"), (F.lit(span[1]) + gap).cast("date"))
            known = spark.read.schema(KEYS).parquet(f"{path}/titles").filter((F.col("batch") < number) & days)
            seen = known.select(F.col("title_key").alias("_key"), F.col("published").alias("_at"))
            close = F.col("_at").between(F.col("published") - gap, F.col("published") + gap)
            first = first.join(seen, (F.col("_key") == F.col("title_key")) & close, "left_anti")
        kept = first.unionByName(keyed.filter("title_key IS NULL")).select(*names)
        target = f"{path}/articles/batch={number}"
        kept.write.mode("overwrite").parquet(target)
        # Keys follow from what was written, so both tables agree whenever a trigger is tried again.
        done = spark.read.schema(kept.schema).parquet(target)
        keys = done.select(
            F.nullif(title_key(F.col("title")), F.lit("")).alias("title_key"), "published",
            F.lit(number).alias("batch"), F.col("published").cast("date").alias("day"),
        )
        writer = keys.filter("title_key IS NOT NULL").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch", "day").parquet(f"{path}/titles")

    return write


def dedup_stream(
    articles: DataFrame, path: str, checkpoint: str, window: str = "10 DAYS", lateness: str = "5 days", every: str | None = None
) -> StreamingQuery:
    """Keep the articles of a stream in the table ``path``/articles, exactly once. Runs on with the given trigger interval,
    or stops after all available input without one and goes on from the checkpoint when started again."""
    writer = first_urls(articles, window, lateness).writeStream.foreachBatch(_keep_titles(path, window, articles.columns))
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
