"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered, so that a
block's name is an integer that no other block has. Then adjacent names are paired, the distinct
pairs sorted and numbered, and so on, until one name is left of each document. Two documents end
at the same level with the same name exactly if their texts are equal: no hash decides anything.

Only documents that share length and 64-bit hash with another are named; equal texts always do,
so nobody else can have a copy. Null counts as empty. Of equal texts the row with the largest id
stays, a null id being the smallest; of rows that agree in id and text one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import digest
from broadsheet.storage import Workspace

BLOCK = 2048


def number_distinct(df: DataFrame, columns: list[str], work: Workspace, name: str = "name") -> DataFrame:
    """The distinct rows of ``columns`` with an integer each, as a table.

    Rows are dealt by hash, as for any distinct, and sorted there; a row's number is its place in
    its partition plus the rows of the partitions before. Range partitioning would sort all of them
    in one order, which names do not need, and would send a sample of whole blocks to the driver.
    """
    place = F.monotonically_increasing_id()
    sorted_ = df.select(*columns).distinct().sortWithinPartitions(*columns)
    slots = work.write(
        sorted_.select("*", F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_place"))
    )
    sizes = slots.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the distinct rows, whatever the data size: safe to broadcast.
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = slots.join(F.broadcast(offsets), "_part")
    return numbered.select(*columns, (F.col("_offset") + F.col("_place")).alias(name))


def name_texts(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rid``, ``level``, ``name`` for each row of ``texts`` (``rid``: unique long, ``text``: not null).

    Rows agree in level and name exactly if their texts are equal. A level holds half the names of
    the one below, so the work is dominated by the first; documents of one name leave.
    """
    work = Workspace(texts.sparkSession, "naming")
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block)).cast("int")
    # Slices of the bytes, which are at hand by place; characters would be counted from the start for each block.
    # The bytes are bound, as a lambda that names the column would copy them for each block.
    slices = F.transform(
        F.array(F.col("text").cast("binary")),
        lambda raw: F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(raw, i * block + 1, F.lit(block))),
    )
    cut = texts.select("rid", count.alias("n"), F.posexplode(F.get(slices, F.lit(0))).alias("i", "block"))
    blocks = work.write(cut.select("rid", "i", "n", "block"))
    names = number_distinct(blocks, ["block"], work)
    current = work.write(blocks.join(names, "block").select("rid", "i", "n", "name"))
    done = current.filter("n = 1").select("rid", F.lit(0).alias("level"), "name")
    level = 0
    current = current.filter("n > 1")
    while not current.isEmpty():
        level += 1
        second = F.col("i") % 2 == 1
        pairs = work.write(
            current.groupBy("rid", F.floor(F.col("i") / 2).cast("int").alias("i")).agg(
                F.max(F.when(~second, F.col("name"))).alias("left"),
                # A last block without partner is paired with -1, which names nothing.
                F.coalesce(F.max(F.when(second, F.col("name"))), F.lit(-1)).alias("right"),
                F.ceil(F.first("n") / 2).cast("int").alias("n"),
            )
        )
        names = number_distinct(pairs, ["left", "right"], work)
        current = work.write(pairs.join(names, ["left", "right"]).select("rid", "i", "n", "name"))
        done = done.union(current.filter("n = 1").select("rid", F.lit(level).alias("level"), "name"))
        current = current.filter("n > 1")
    return done


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of docs: the id as ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest`` (SHA-256 of
    the text in UTF-8)."""
    work = Workspace(docs.sparkSession, "exact")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signature = [F.length("text").alias("chars"), F.xxhash64("text").alias("hash")]
    # A table of its own, so that the join is between two exchanges and a hot signature can be split.
    shared = work.write(
        rows.select(*signature).groupBy("chars", "hash").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    )
    found = rows.select("id", "text", digest(F.col("text")).alias("digest"), *signature).join(
        shared, ["chars", "hash"], "left"
    )
    table = work.write(
        found.select(
            F.monotonically_increasing_id().alias("rid"), "id", "digest", F.when(F.col("rows").isNotNull(), F.col("text")).alias("text")
        )
    )
    candidates = table.filter("text IS NOT NULL")
    named = work.write(
        name_texts(candidates.select("rid", "text"), block).join(candidates.select("rid", "id", "digest"), "rid")
    )
    # A row number breaks ties between rows of equal id and text. A table again, for a hot name.
    best = work.write(
        named.groupBy("level", "name").agg(F.max(F.struct("id", "rid")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    )
    grouped = named.join(best, ["level", "name"]).select(
        "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("rid") == F.col("best.rid")).alias("kept"), "digest"
    )
    alone = table.filter("text IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    return alone.union(grouped)
