"""Mixing sources to target weights, in fixed-length blocks of words.

The words of a source are packed into blocks of ``block`` words. A mix is a number of output
shards, each a number of slots. How many slots of a shard each source fills is a multinomial
draw, made so that the shards together fill every source's quota exactly: the shards are halved
again and again, and each half's counts are drawn from what is left at that node. A shard's task
walks down to it, so no task draws for others. The slots of a source are numbered through the
whole mix; slot numbers become block numbers by a pseudorandom permutation of the source's
blocks, another one each time all blocks are used up, and blocks are joined by number.

Everything derives from a seed and the rows, so reruns agree. Sources are ordered by code point,
null last; null and empty texts have no words. A source without words has target 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import WORD_PATTERN, row_key
from broadsheet.llm.rows import number_sorted
from broadsheet.storage import Workspace

# Rows of one source whose word offsets are summed in one task.
CHUNK_ROWS = 5_000
SHARDS_PER_TASK = 64


def water_level(sources: DataFrame, share: float, cap: float) -> float:
    """The words per unit of weight at which sources, none above ``cap`` times its size, reach
    ``share`` times the size of all.

    Starts at an even level and raises it by the excess of the sources above their cap until no
    further one is above; each step is one aggregation over the table of sources.
    """
    limit = F.col("source_size") * cap
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > limit
        row = sources.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("n"),
            F.sum(F.when(above, limit).otherwise(0.0)).alias("full"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == capped or not row["weight"]:
            return level or 0.0
        level, capped = (share * total - row["full"]) / row["weight"], row["n"]


def plan_sources(
    sized: DataFrame, weights: tuple[float, ...], share: float, cap: float, block: int, work: Workspace
) -> DataFrame:
    """One row per source: ``source_no`` in code point order, size, weight, target, ``blocks`` and
    ``quota``, the number of slots that brings its words nearest the target."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = number_sorted(sizes, [F.col("source").asc_nulls_last()], work, "source_no")
    cycle = F.array(*(F.lit(float(weight)) for weight in weights))
    weighed = work.write(
        numbered.withColumn("weight", F.get(cycle, (F.col("source_no") % len(weights)).cast("int")))
    )
    level = water_level(weighed, share, cap)
    size = F.col("source_size")
    return work.write(
        weighed.withColumn("target", F.least(F.col("weight") * level, size * cap).cast("double"))
        .withColumn("blocks", F.ceil(size / block).cast("bigint"))
        .withColumn("quota", F.coalesce(F.round(F.col("target") * F.col("blocks") / F.when(size > 0, size)), F.lit(0)).cast("bigint"))
    )


def pack(sized: DataFrame, sources: DataFrame, work: Workspace) -> DataFrame:
    """``sized`` rows with ``source_no`` and ``start``, the offset of their first word in their source.

    A running sum in hashed chunks of each source, and the chunks' sums summed up; a source with
    a third of all rows is as many chunks as its size asks for.
    """
    chunks = max(1, -(-sized.count() // CHUNK_ROWS))
    named = sized.join(sources.select("source", "source_no").withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
    chunked = named.drop("_s").withColumn("chunk", F.pmod(F.xxhash64("id", "size", "key"), F.lit(chunks)))
    sums = chunked.groupBy("source_no", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source_no", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("id", "size", "key").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunked.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["source_no", "chunk"])
    return work.write(placed.withColumn("start", F.col("offset") + F.col("inside")).drop("chunk", "offset", "inside"))


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """Each document's share of each block it lies in: ``block``, ``at`` (its place there), ``skip`` (words of the
    document before it) and ``words``."""
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), last)))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return cut.withColumns({"at": begin - F.col("block") * block, "skip": begin - F.col("start"), "words": end - begin})


def split_counts(counts: np.ndarray, left: int, seed: list[int]) -> np.ndarray:
    """Multinomial counts for ``left`` slots out of those that ``counts`` leaves to each source; what goes
    beyond a source's own is drawn again from the others."""
    rng = np.random.default_rng(seed)
    drawn = np.zeros_like(counts)
    while (short := left - int(drawn.sum())) > 0:
        room = counts - drawn
        drawn = np.minimum(counts, drawn + rng.multinomial(short, room / room.sum()))
    return drawn


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, size: int, seed: list[int]) -> np.ndarray:
    """The images of ``numbers`` under a pseudorandom permutation of 0 .. size - 1: a Feistel network
    over the next even number of bits, walked until it is back in range."""
    half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.SeedSequence(seed).generate_state(4, np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for key in keys:
            left, right = right, left ^ (_mix64(right + key) & low)
        return (left << half) | right

    out = once(numbers.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def draw_slots(spark, sources: DataFrame, per_shard: int, seed: int) -> DataFrame:
    """``shard``, ``position``, ``source_no``, ``slot``, ``block`` of every slot of the mix. The driver and each task
    hold three numbers per source."""
    rows = sorted(map(tuple, sources.filter("quota > 0").select("source_no", "blocks", "quota").collect()))
    schema = "shard BIGINT, position INT, source_no BIGINT, slot BIGINT, block BIGINT"
    if not rows:
        return spark.createDataFrame([], schema)
    numbers, blocks, quotas = (np.array(column, np.int64) for column in zip(*rows))
    total = int(quotas.sum())
    shards = -(-total // per_shard)

    def slots_before(shard: int) -> int:
        return shard * (total // shards) + min(shard, total % shards)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        @lru_cache(maxsize=256)
        def node(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
            """Counts of the shards low .. high - 1, and the slots of each source before them."""
            if (low, high) == (0, shards):
                return quotas, np.zeros_like(quotas)
            # The parent follows from the path that halving takes from the root.
            a, b = 0, shards
            while True:
                middle = (a + b) // 2
                if (low, high) in ((a, middle), (middle, b)):
                    break
                a, b = (a, middle) if high <= middle else (middle, b)
            counts, before = node(a, b)
            left = split_counts(counts, slots_before(middle) - slots_before(a), [seed, a, b])
            return (left, before) if high == middle else (counts - left, before + left)

        for batch in batches:
            for shard in map(int, batch["id"]):
                a, b = 0, shards
                while b - a > 1:
                    middle = (a + b) // 2
                    a, b = (a, middle) if shard < middle else (middle, b)
                counts, before = node(a, b)
                parts = []
                for i in np.flatnonzero(counts):
                    slot = before[i] + np.arange(counts[i])
                    block = np.empty_like(slot)
                    for turn in np.unique(slot // blocks[i]):
                        own = slot // blocks[i] == turn
                        block[own] = permuted(slot[own] % blocks[i], int(blocks[i]), [seed, int(numbers[i]), int(turn)])
                    parts.append(pd.DataFrame({"source_no": numbers[i], "slot": slot, "block": block}))
                made = pd.concat(parts, ignore_index=True)
                made.insert(0, "shard", shard)
                made.insert(1, "position", np.random.default_rng([seed, shards, shard]).permutation(len(made)).astype(np.int32))
                yield made

    return spark.range(0, shards, 1, -(-shards // SHARDS_PER_TASK)).mapInPandas(run, schema)


@dataclass
class Mix:
    """``sources``: plan of each source; ``placed``: documents in their sources; ``slots``: the mix; ``block``: words a block."""

    sources: DataFrame
    placed: DataFrame
    slots: DataFrame
    block: int

    def taken(self) -> DataFrame:
        """``placed`` rows with the number of their words in the mix, repeats counted."""
        uses = self.slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("uses"))
        shares = pieces(self.placed, self.block).join(uses, ["source_no", "block"], "left")
        sums = shares.groupBy("source_no", "start", "id", "source", "size").agg(
            F.coalesce(F.sum(F.col("words") * F.col("uses")), F.lit(0)).alias("taken")
        )
        empty = self.placed.filter("size = 0").select("source_no", "start", "id", "source", "size", F.lit(0).cast("bigint").alias("taken"))
        return sums.unionByName(empty)

    def report(self) -> DataFrame:
        """Per document: its id, size, its source's size and target, and its words taken."""
        plan = self.sources.select("source_no", "source_size", "target")
        return self.taken().join(plan, "source_no").select(
            F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source"
        )

    def blocks(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The mixed text itself: ``shard``, ``position``, ``source_no``, ``text``, one row per slot.

        Documents are cut into their pieces before anything is repeated, so each word moves once
        to its block and once for each slot that takes it.
        """
        texts = docs.select(
            F.unhex(row_key(F.col(id_col), F.col(text_col))).alias("key"), F.col(text_col).alias("text")
        ).dropDuplicates(["key"])
        words = F.regexp_extract_all("text", F.lit(f"({WORD_PATTERN})"), F.lit(1))
        cut = pieces(texts.join(self.placed, "key").withColumn("all", words), self.block)
        part = F.array_join(F.slice("all", (F.col("skip") + 1).cast("int"), F.col("words").cast("int")), " ")
        made = cut.select("source_no", "block", "at", part.alias("part"))
        whole = made.groupBy("source_no", "block").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))
        return self.slots.join(whole, ["source_no", "block"]).select(
            "shard", "position", "source_no", F.array_join(F.col("parts.part"), " ").alias("text")
        )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    cap: float = 2.0,
    block: int = 64,
    per_shard: int = 1024,
    seed: int = 20,
) -> Mix:
    """A mix of ``share`` times all words, sources weighing ``weights`` in turn and none taken more than
    ``cap`` times; ``cap`` also bounds how often a block, and so a document, is used."""
    work = Workspace(docs.sparkSession, "mix")
    sized = work.write(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("size"),
            F.unhex(row_key(F.col(id_col), F.col(text_col))).alias("key"),
        )
    )
    sources = plan_sources(sized, weights, share, cap, block, work)
    placed = pack(sized, sources, work)
    slots = work.write(draw_slots(docs.sparkSession, sources, per_shard, seed))
    return Mix(sources, placed, slots, block)
