"""Order, caps and row numbers of article lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.dates import display_date
from broadsheet.storage import Workspace


def date_number(stamp: Column) -> Column:
    """The first eight characters as a number, 0 for none."""
    return F.coalesce(F.substring(stamp, 1, 8).try_cast("int"), F.lit(0))


def rank_order() -> list[Column]:
    """Tier up, date down, then the input order, which makes the sort a stable one."""
    return [F.col("tier").asc(), date_number(F.col("seendate")).desc(), F.col("ord").asc()]


def tier_order() -> list[Column]:
    return [F.col("tier").asc(), F.col("ord").asc()]


def top(df: DataFrame, n: int | None, order: list[Column] | None = None) -> DataFrame:
    """The first n rows of the ranking; all of them, unsorted, without a cap."""
    return df if n is None else df.orderBy(*(order or rank_order())).limit(n)


def number_top(df: DataFrame, n: int | None) -> DataFrame:
    """The first n rows of the ranking with ``idx`` from 1; one window over n rows at most. Without a
    cap the whole list, numbered by ``number_wide``."""
    if n is None:
        return number_wide(df)
    return top(df, n).withColumn("idx", F.row_number().over(Window.orderBy(*rank_order())).cast("bigint"))


def number_rows(df: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """The whole ranking with ``idx`` from 1, without bringing it into one task.

    A range-partitioned sort is written as a table together with each row's partition and its
    place there. The order is total, since ``ord`` is unique, so equal tiers and dates spread over
    many partitions. One count per partition then gives the offsets.
    """
    place = F.monotonically_increasing_id()
    ranked = df.orderBy(*(order or rank_order()))
    slots = ranked.select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_place"))
    table = Workspace(df.sparkSession, "ranking").write(slots)
    sizes = table.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    # One row per partition of the sort: broadcasting it is safe at every data size.
    numbered = table.join(F.broadcast(offsets), "_part")
    return numbered.withColumn("idx", F.col("_offset") + F.col("_place") + 1).drop("_part", "_place", "_offset")


def number_wide(df: DataFrame, rows_least: int = 1_000, rows_most: int = 100_000) -> DataFrame:
    """The whole ranking with ``idx`` from 1, as by ``number_rows``, for rows with long texts: these are moved once and
    make no table of their own. ``df`` is read twice and must give the same rows.

    The order's columns alone are numbered first. Of them, one key for each part of the list tells where the part
    begins and which number that is; every row finds its part among them, and is numbered by its place there.
    Rows that agree in the whole key fall in one part, so parts may differ in size where keys repeat.
    """
    spark = df.sparkSession
    wide = df.withColumn("_key", F.struct("tier", (-date_number(F.col("seendate"))).alias("date"), "ord"))
    order = [F.col("_key").asc()]
    keys = Workspace(spark, "ranking").write(number_rows(wide.select("_key"), order))
    rows = keys.count()
    if not rows:
        return df.withColumn("idx", F.lit(0).cast("bigint"))
    parts = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_least)), -(-rows // rows_most))
    size = -(-rows // parts)
    each = keys.groupBy("_key").agg(F.min("idx").alias("first"), F.max("idx").alias("last"))
    # The keys of the rows that a part of even size would begin with, whatever repeats around them: ``parts`` at most.
    begins = each.filter(F.floor((F.col("last") - 1) / size) > F.floor((F.col("first") - 2) / size)).orderBy("_key")
    found = begins.select(F.to_json(F.struct("_key"), {"ignoreNullFields": "false"}).alias("key"), (F.col("first") - 1).alias("before")).collect()
    kind = wide.select("_key").schema["_key"].dataType.simpleString()
    bounds = F.from_json(F.lit(f"[{','.join(row['key'] for row in found)}]"), f"array<struct<_key:{kind}>>")
    # A binary search: the last part that does not begin after the row.
    steps = [1 << i for i in reversed(range(len(found).bit_length()))]
    part = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step)["_key"] <= F.col("_key"), at + step).otherwise(at),
    )
    sorted_parts = wide.repartitionById(len(found), part).sortWithinPartitions("_key").drop("_key")
    place = F.monotonically_increasing_id()
    before = F.get(F.lit([row["before"] for row in found]).cast("array<bigint>"), F.shiftright(place, 33).cast("int"))
    return sorted_parts.withColumn("idx", before + place.bitwiseAND((1 << 33) - 1) + 1)


def source_lines(df: DataFrame) -> DataFrame:
    """The three printed lines of each numbered article as one ``line`` value."""
    return df.select(
        "idx",
        F.concat_ws(
            "\n",
            F.concat(F.col("idx").cast("string"), F.lit(". "), F.col("title")),
            F.concat(F.lit("Date: "), display_date(F.col("seendate"))),
            F.concat(F.lit("Source: "), F.col("url"), F.lit("\n")),
        ).alias("line"),
    )


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group. Spark cuts each map task's share of a group to one row before
    the shuffle (window group limit), so a group may be of any size."""
    numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("_n") == 1).drop("_n")
