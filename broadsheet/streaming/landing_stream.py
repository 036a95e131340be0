"""Continuous landing of articles; the digest is computed on demand from what has landed.

The stream does the stateless part once per item and appends to a table: parsing, title and domain
tests, and dates, read as of the moment the item arrived, so that a date without a year stays right
however long the stream runs. Whether an article lies in the window is asked when the table is
read. Deduplication, triage and ranking depend on the whole window and its order, so they run over
the table, reading only the days of the window. No stream state grows with the data, and the
result equals that of a batch run over the same items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet import fixed_values as fixed
from broadsheet.operators.normalize import admit, describe
from broadsheet.schema import LANDED
from broadsheet.settings import Settings
from broadsheet.sources.landing import enabled


def land_articles(
    raw: DataFrame, settings: Settings, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append the articles of a stream of raw items to the table at ``path``, exactly once.

    An item arrived at its ``arrived`` (TIMESTAMP_NTZ) or, where the stream has no such column, at
    the start of the trigger that reads it. Runs on with the given trigger interval, or stops after
    all available input without one.
    """
    if "arrived" not in raw.columns:
        raw = raw.withColumn("arrived", F.current_timestamp().cast("timestamp_ntz"))
    described = describe(enabled(raw, settings), settings, F.col("arrived"))
    writer = described.writeStream.format("parquet").partitionBy("api_source", "seendate")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.outputMode("append").start(path)


def landed_window(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    """Articles of the window, as a batch run at the settings' time would admit them. Sources that need
    a date only have the partitions of the window's days read."""
    table = spark.read.schema(LANDED).parquet(path)
    first = settings.cutoff.strftime("%Y%m%d")
    days = ~F.col("api_source").isin(*fixed.DATED_SOURCES) | (F.col("seendate") >= first)
    return admit(table.filter(days), settings).select("ord", "title", "url", "domain", "seendate", "api_source", "tier", "reasoning")
