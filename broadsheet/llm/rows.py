"""Numbering rows, and applying decisions about rows, found without their other columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import digest, free_name
from broadsheet.storage import Workspace


def number_sorted(df: DataFrame, order: list[Column], work: Workspace, name: str) -> DataFrame:
    """``df`` with the rows' numbers from 0 in a total ``order``: a range-partitioned sort, written as a
    table, and offsets from one count per partition. No global window."""
    place = F.monotonically_increasing_id()
    slots = work.write(
        df.orderBy(*order).select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_place"))
    )
    sizes = slots.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, whatever the data size: safe to broadcast.
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = slots.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_place")).alias(name))


def keep_decided(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in ``dropped`` (``id``, ``digest``, ``n``: how many of the rows that
    agree in id and text go). All columns of docs stay as they are, whatever their names.

    Join and window share one partitioning by id and digest, so the text moves once.
    """
    names = [free_name(docs, name) for name in ("_id", "_digest", "_n", "_row")]
    id_, mark, count, row = names
    keyed = docs.withColumns({id_: F.coalesce(F.col(id_col).cast("string"), F.lit("null")), mark: digest(F.col(text_col))})
    marks = dropped.select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias(id_), F.col("digest").alias(mark), F.col("n").alias(count)
    )
    joined = keyed.join(marks, [id_, mark], "left")
    copies = Window.partitionBy(id_, mark).orderBy(id_)
    alive = joined.withColumn(row, F.row_number().over(copies)).filter(F.col(row) > F.coalesce(F.col(count), F.lit(0)))
    return alive.select(*(F.col(f"`{name}`") for name in docs.columns))
