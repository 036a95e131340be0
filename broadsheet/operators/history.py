"""Deduplication across runs: the url and title keys that earlier runs kept, as a bucketed table.

A run's articles come after those of all earlier runs. So the greedy rule over all runs together is
the one over the new articles alone, once those go whose url or title an earlier run kept: nothing
already published is read or moved again, only fixed-size keys are.

Keys are 16 bytes of SHA-256. The table is partitioned by run and bucketed by key, so a join by key
shuffles the new side only, into as many parts as there are buckets. Which new keys are known is
found first, by a semi join that reduces the history: with runtime filters on, the optimizer sends a
Bloom filter of the new keys into the scan of the history where that is large enough to pay. The
known keys are never more than the new ones, and the articles are joined with those.

A run replaces its own keys, so a run that is tried again leaves the same table, and it never sees its own or
later runs' keys.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.functions.text import title_key
from broadsheet.functions.urls import canonical_url
from broadsheet.operators.dedup import dedup_greedy
from broadsheet.operators.filters import filter_nonempty
from broadsheet.storage import Workspace, path_exists

SCHEMA = "key BINARY, run STRING"


def _key(kind: str, value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(F.lit(kind), value).cast("binary"), 256), 1, 32))


def url_key() -> Column:
    return _key("u", canonical_url(F.col("url")))


def title_keys() -> Column:
    """NULL for a title without letters and digits, which matches nothing."""
    key = title_key(F.col("title"))
    return F.when(key != "", _key("t", key))


class KeptKeys:
    """The table ``name`` at ``path``; it is declared where the catalog does not have it yet.

    ``buckets`` is fixed once the table has rows: about one per 100 MB of keys of the longest history."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} ({SCHEMA}) USING parquet PARTITIONED BY (run) "
                f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'"
            )
            if path_exists(spark, path):
                spark.catalog.recoverPartitions(name)

    def before(self, run: str) -> DataFrame:
        """The keys of runs before this one; only their partitions are read."""
        return self.spark.table(self.name).filter(F.col("run") < run).select("key")

    def record(self, kept: DataFrame, run: str) -> None:
        """Make the keys of the kept articles those of the run, in place of what an earlier attempt left."""
        keys = kept.select(F.explode(F.array_compact(F.array(url_key(), title_keys()))).alias("key")).distinct()
        # One file per bucket: rows are dealt as the table's buckets are. A static partition is all that is replaced.
        dealt = keys.repartition(self.buckets, "key")
        if not re.fullmatch(r"[\w :.+-]+", run):
            raise ValueError(f"a run is named by letters, digits and separators, not {run!r}")
        self.spark.sql(f"INSERT OVERWRITE {self.name} PARTITION (run = '{run}') SELECT key FROM {{dealt}}", dealt=dealt)


def dedup_new(articles: DataFrame, history: KeptKeys, run: str) -> DataFrame:
    """The articles of a run that stay: those that a greedy walk over all runs up to this one would keep.

    ``articles`` are read twice; give a table. Rows without url or title go, as in ``dedup_greedy``.
    """
    work = Workspace(articles.sparkSession, "history")
    items = filter_nonempty(articles, "url", "title")
    keys = items.select("ord", url_key().alias("_url"), title_keys().alias("_title"))
    wanted = keys.select(F.explode(F.array_compact(F.array("_url", "_title"))).alias("key")).distinct()
    known = work.write(history.before(run).join(wanted, "key", "left_semi").distinct())
    # A null title key joins nothing and stays.
    by_url = keys.join(known.withColumnRenamed("key", "_url"), "_url", "left_anti")
    fresh = by_url.join(known.withColumnRenamed("key", "_title"), "_title", "left_anti").select("ord")
    return dedup_greedy(items.join(fresh, "ord", "left_semi"))


def run_daily(articles: DataFrame, history: KeptKeys, run: str) -> DataFrame:
    """One run: what stays of its articles, as a table, after its keys have been recorded."""
    kept = Workspace(articles.sparkSession, "daily").write(dedup_new(articles, history, run))
    history.record(kept, run)
    return kept
