"""Landed payloads kept by the day they came in, so that a window reads only its own days.

``path/source=S/ingest_day=D`` holds the payloads of a source and day: ``payload_no``, unique in its source, and
``payload``. Landing a day again replaces it, so a repeated run adds nothing twice. Items of a payload are never
dated after the day it came in; a source that announces later dates is read with as many days of ``slack``.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.settings import Settings


class PayloadTable:
    """The table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def land(self, payloads: DataFrame, source: str) -> None:
        """Write payloads (``payload_no``, ``payload``, ``ingest_day``); the days among them are replaced.

        Dealt by range of day and number: a day is in few files, a crowded one in many.
        """
        rows = payloads.select("payload_no", "payload", "ingest_day").repartitionByRange("ingest_day", "payload_no")
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_day")
        writer.parquet(f"{self.path}/source={source}")

    def _source(self, source: str) -> DataFrame:
        return self.spark.read.schema("payload_no BIGINT, payload STRING, ingest_day DATE").parquet(f"{self.path}/source={source}")

    def read(self, source: str, settings: Settings, slack: int = 0) -> DataFrame:
        """Payloads that can hold items of the run's window, as the readers in ``landing`` take them; older
        days are not even listed as input."""
        first = settings.cutoff.date() - timedelta(days=slack)
        return self._source(source).filter(F.col("ingest_day") >= F.lit(first)).select("payload_no", "payload")

    def read_days(self, source: str, days: DataFrame, day: str = "day") -> DataFrame:
        """Payloads of the days in a table, however often it has them. The days are known when the query runs,
        and prune the partitions then."""
        wanted = days.select(F.col(day).cast("date").alias("ingest_day")).distinct()
        # The optimizer prunes at run time if it sees a comparison on the table's side; nothing was landed before 1970.
        wanted = wanted.filter(F.col("ingest_day") >= F.lit(date(1970, 1, 1)))
        return self._source(source).join(wanted, "ingest_day", "left_semi").select("payload_no", "payload")
