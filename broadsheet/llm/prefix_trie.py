"""Prefix tries of conversations by range minima over sorted common prefixes.

Conversations are sorted by their sequences of turns, so that those sharing a prefix are neighbours,
and ``lcp`` is the number of leading turns a conversation shares with the one before it. The members of
a prefix of d turns of the conversation at place i are then the places around i that are reached over
values of ``lcp`` of at least d. A sparse table of range minima (level k: minima over 2^k neighbours) lets
each candidate prefix find its left and its right extent by binary search, independently of all others;
no stack is walked. Nodes with two members or more start at places where a prefix occurs first; all
deeper prefixes have one member.

Scale. Places are cut into blocks. A task holds one block's table at a time and answers what ends
inside. What crosses a block's edge depends on edge and depth alone: per edge there are as many such
extents as the turns shared across it. These are searched in a second sparse table over the blocks,
which is a Spark table: one join per level, each candidate jumping 2^k blocks at a time. So no group is
gathered however many conversations share a prefix. Texts stay where they are: a turn moves as 16
bytes of its SHA-256, its place and its length. Sequences are handled in pieces of 32 turns whose
ranks order conversations, so a very long conversation is one array of a 32nd of its turns.

Defined cases: null role or text counts as empty; turns come in the order of ``turn``, null first, ties by the
turn's digest; repeated rows are turns of their own; rows without a conversation id belong to none and
are left out; an empty table has no nodes; columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.rows import number_sorted
from broadsheet.storage import Workspace

PIECE = 32
BLOCK = 4096
# Conversation ids per row of a list that is hashed in order.
LIST_ROWS = 4096
NONE = -1


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes that tell turns apart by role and text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    framed = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(framed.cast("binary"), 256), 1, 32))


def read_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Tables of turns (``conv``, ``pos`` from 0, ``digest``, ``size`` of the text in bytes) and of conversations (``conv``, ``n``)."""
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        turn_digest(F.col(role_col), F.col(text_col)).alias("digest"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size"),
    )
    # Sorted by range and numbered by offsets: one conversation may hold any share of all turns.
    numbered = number_sorted(turns, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")], work, "no")
    convs = work.write(numbered.groupBy("conv").agg(F.min("no").alias("start"), F.count(F.lit(1)).alias("n")))
    placed = numbered.join(convs.select("conv", "start"), "conv")
    return work.write(placed.select("conv", (F.col("no") - F.col("start")).alias("pos"), "digest", "size")), convs.select("conv", "n")


def splice(turns: DataFrame, convs: DataFrame, donor: Column, head: Column, longest_head: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns are those of ``donor`` (none if there is no such conversation),
    followed by their own turns after the first ``head``. ``donor`` and ``head`` are made of ``conv``; ``head`` is
    at most ``longest_head``."""
    plan = convs.select("conv", "n", donor.alias("donor"), head.cast("long").alias("head"))
    sizes = convs.select(F.col("conv").alias("donor"), F.col("n").alias("have"))
    plan = plan.join(sizes, "donor", "left").withColumn("lent", F.least("head", F.coalesce("have", F.lit(0).cast("long"))))
    own = turns.join(plan.select("conv", "head", "lent"), "conv").filter("pos >= head")
    own = own.select("conv", (F.col("pos") - F.col("head") + F.col("lent")).alias("pos"), "digest", "size")
    heads = turns.filter(F.col("pos") < longest_head).withColumnRenamed("conv", "donor")
    lent = heads.join(plan.select("conv", "donor", "head"), "donor").filter("pos < head")
    rebuilt = own.unionByName(lent.select("conv", "pos", "digest", "size"))
    lengths = plan.select("conv", (F.col("lent") + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("n"))
    return rebuilt, lengths


def sort_conversations(turns: DataFrame, convs: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """The table of sorted conversations, and that of their pieces.

    Conversations: ``no``, ``conv``, ``n``, ``total`` (bytes), ``lcp`` (-1 at the first place) and ``before`` (bytes of the
    ``lcp`` first turns). Pieces: ``conv``, ``piece``, ``turns``, ``sums`` (bytes up to each turn's start), ``start`` (bytes before).
    """
    place = F.struct("pos", "digest", "size")
    cut = turns.withColumn("piece", F.expr(f"pos div {PIECE}")).groupBy("conv", "piece").agg(F.sort_array(F.collect_list(place)).alias("t"))
    sums = F.aggregate(
        "t", F.array(F.lit(0).cast("long")), lambda done, t: F.concat(done, F.array(F.element_at(done, -1) + t["size"]))
    )
    cut = cut.select("conv", "piece", F.col("t.digest").alias("turns"), sums.alias("sums"))
    mark = F.unhex(F.substring(F.sha2(F.aggregate("turns", F.lit(b""), lambda a, b: F.concat(a, b)), 256), 1, 32))
    cut = work.write(cut.withColumn("mark", mark))
    before = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.select("conv", "piece", "mark", F.element_at("sums", -1).alias("sum"))
    starts = starts.withColumn("start", F.coalesce(F.sum("sum").over(before), F.lit(0).cast("long")))
    # The rank of a piece among all different ones keeps the order of its turns.
    ranks = number_sorted(cut.groupBy("mark").agg(F.first("turns").alias("turns")), [F.col("turns")], work, "rank")
    ranked = work.write(starts.join(work.write(ranks.select("mark", "rank")), "mark").drop("mark"))
    sequences = ranked.groupBy("conv").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("piece", "rank"))), lambda p: p["rank"]).alias("ranks"),
        F.sum("sum").alias("total"),
    )
    pieces = work.write(cut.select("conv", "piece", "turns", "sums").join(ranked.select("conv", "piece", "start"), ["conv", "piece"]))
    whole = convs.join(sequences, "conv", "left").select(
        "conv", "n", F.coalesce("total", F.lit(0).cast("long")).alias("total"),
        F.coalesce("ranks", F.array().cast("array<bigint>")).alias("ranks"),
    )
    places = number_sorted(whole, [F.col("ranks"), F.col("conv")], work, "no")

    # Each conversation beside the one before it: the last of a block is shown to the next block as well.
    block = F.expr(f"no div {BLOCK}")
    seen = places.select("*", F.explode(F.array_distinct(F.array(block, F.expr(f"(no + 1) div {BLOCK}")))).alias("block"))
    order = Window.partitionBy("block").orderBy("no")
    beside = seen.withColumns({"last": F.lag("conv").over(order), "other": F.lag("ranks").over(order)})
    beside = beside.filter(F.col("block") == block)
    same = F.array_position(F.zip_with("ranks", "other", lambda a, b: a.eqNullSafe(b)), False).cast("long")
    # The first piece that differs; -1 where all agree.
    beside = work.write(beside.select("no", "conv", "n", "total", "last", (same - 1).alias("piece")))
    left = pieces.select("conv", "piece", "turns", "sums", "start")
    right = pieces.select(F.col("conv").alias("last"), "piece", F.col("turns").alias("others"))
    pairs = beside.join(left, ["conv", "piece"], "left").join(right, ["last", "piece"], "left")
    # In sorted order a conversation has the piece that differs from the one before, which may have ended.
    others = F.coalesce("others", F.array().cast("array<binary>"))
    at = (F.array_position(F.zip_with("turns", others, lambda a, b: a.eqNullSafe(b)), False) - 1).cast("int")
    first, equal = F.col("last").isNull(), F.col("piece") < 0
    lcp = F.when(first, F.lit(NONE)).when(equal, F.col("n")).otherwise(F.col("piece") * PIECE + at).cast("long")
    known = F.when(first, F.lit(0)).when(equal, F.col("total")).otherwise(F.col("start") + F.get("sums", at))
    return work.write(pairs.select("no", "conv", "n", "total", lcp.alias("lcp"), known.cast("long").alias("before"))), pieces


# Rows of the block pass. CANDIDATE: the prefix of a place and its predecessor; NODE: a prefix of two members or
# more, at the first place that has it; HEAD and TAIL: what a block's first and last places reach inwards at one
# depth, for extents that come from the blocks beside; SUMMARY: a whole block.
CANDIDATE, NODE, HEAD, TAIL, SUMMARY = range(5)
_SUMS = ("rows", "total", "fresh", "leaves")
_FIELDS = (
    "kind", "block", "no", "depth", "conv", "n", "next", "own", "first", "least", *_SUMS, "open_left", "open_right", "pass_left", "pass_right"
)
_FOUND = ", ".join(f"{name} BIGINT" for name in _FIELDS)
_CHUNK = 1 << 18


class SparseTable:
    """Minima over all runs of 2^k neighbours."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            half = 1 << len(self.levels) - 1
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minima over low..high, both included."""
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][low[at]], self.levels[k][high[at] - (1 << int(k)) + 1])
        return out

    def right(self, place: np.ndarray, depth: np.ndarray, last: int) -> np.ndarray:
        """The last place, up to ``last``, reached from ``place`` over values of at least ``depth``."""
        place = place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            step = (place + (1 << k) <= last) & (level[np.minimum(place + 1, len(level) - 1)] >= depth)
            place[step] += 1 << k
        return place

    def left(self, place: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The first place reached from ``place`` over values of at least ``depth``, its own one included."""
        place = place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            start = place - (1 << k) + 1
            step = (start >= 1) & (level[np.clip(start, 0, len(level) - 1)] >= depth)
            place[step] -= 1 << k
        return place


def _solve(block: int, data: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The rows of one block. ``data`` may end with the first place of the next block."""
    inside = data["no"] // BLOCK == block
    base, m = int(data["no"][0]), int(inside.sum())
    conv, n, total, lcp = (data[name][:m] for name in ("conv", "n", "total", "lcp"))
    edge = int(data["lcp"][m]) if m < len(inside) else NONE
    after = np.append(lcp[1:], edge)
    fresh, leaves = total - data["before"][:m], (after < n).astype(np.int64)
    depths, ids = SparseTable(lcp), SparseTable(conv)
    sums = {"total": total, "fresh": fresh, "leaves": leaves}
    sums = {name: np.concatenate([[0], np.cumsum(values)]) for name, values in sums.items()}

    def rows(kind: int, **columns) -> pa.RecordBatch:
        size = max(len(np.atleast_1d(x)) for x in columns.values())
        columns |= {"kind": kind, "block": block}
        return pa.RecordBatch.from_arrays(
            [pa.array(np.broadcast_to(columns.get(name, 0), size).astype(np.int64)) for name in _FIELDS], list(_FIELDS)
        )

    def reach(low: np.ndarray, high: np.ndarray, skip_first: int) -> dict:
        """What lies in low..high; fresh bytes without the first place if it starts the prefix."""
        out = {name: sums[name][high + 1] - sums[name][low] for name in ("total", "leaves")}
        return out | {"rows": high - low + 1, "fresh": sums["fresh"][high + 1] - sums["fresh"][low + skip_first], "least": ids.least(low, high)}

    at = np.arange(m)
    low, high = depths.left(at, lcp), depths.right(at, lcp, m - 1)
    yield rows(
        CANDIDATE, no=base + at, depth=lcp, conv=conv, n=n, next=after, first=base + low, least=ids.least(low, high),
        open_left=(low == 0) & (lcp[0] >= lcp) & (lcp >= 0), open_right=(high == m - 1) & (edge >= lcp) & (lcp >= 0),
    )
    ends = np.cumsum(np.maximum(np.minimum(n, after) - lcp, 0))
    for start in range(0, int(ends[-1]), _CHUNK):
        flat = np.arange(start, min(start + _CHUNK, int(ends[-1])))
        j = np.searchsorted(ends, flat, "right")
        depth = np.minimum(n, after)[j] - (ends[j] - flat) + 1
        high = depths.right(j, depth, m - 1)
        yield rows(
            NODE, no=base + j, depth=depth, conv=conv[j], n=n[j], own=total[j],
            open_right=(high == m - 1) & (edge >= depth), **reach(j, high, 1),
        )
    for start in range(0, int(lcp[0]) + 1, _CHUNK):
        depth = np.arange(start, min(start + _CHUNK, int(lcp[0]) + 1))
        high = depths.right(np.zeros_like(depth), depth, m - 1)
        yield rows(HEAD, depth=depth, **reach(np.zeros_like(depth), high, 0))
    for start in range(0, edge + 1, _CHUNK):
        depth = np.arange(start, min(start + _CHUNK, edge + 1))
        low = depths.left(np.full_like(depth, m - 1), depth)
        yield rows(TAIL, depth=depth, first=base + low, least=ids.least(low, np.full_like(low, m - 1)))
    every = reach(np.array([0]), np.array([m - 1]), 0)
    yield rows(SUMMARY, pass_left=np.array([after.min()]), pass_right=np.array([lcp.min()]), **every)


def _solve_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and place; one block's are held at a time."""
    held: list[pa.RecordBatch] = []
    current = None

    def solve() -> Iterator[pa.RecordBatch]:
        if held:
            table = pa.Table.from_batches(held)
            yield from _solve(current, {name: table[name].to_numpy() for name in ("no", "conv", "n", "total", "lcp", "before")})

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1), len(blocks)]
        for low, high in zip(cuts, cuts[1:]):
            if low == high:
                continue
            if blocks[low] != current:
                yield from solve()
                held, current = [], int(blocks[low])
            held.append(batch.slice(low, high - low))
    yield from solve()


def _reach_over_blocks(found: DataFrame, work: Workspace) -> DataFrame:
    """``side``, ``block``, ``depth``: what lies beyond that block's right (1) or left (-1) edge at that depth, as ``beyond``.

    Blocks are mirrored for the left side, so that both sides search rightwards in one table.
    """
    blocks = found.filter(F.col("kind") == SUMMARY)
    sides = F.explode(
        F.array(*(F.struct(F.lit(side).alias("side"), (F.col("block") * side).alias("at"), F.col(p).alias("value")) for side, p in ((1, "pass_right"), (-1, "pass_left"))))
    )
    level = work.write(blocks.select(sides.alias("s"), "least", *_SUMS).select("s.*", "least", *_SUMS))
    count = blocks.count()
    levels = [level]
    while 1 << len(levels) < count:
        half = 1 << len(levels) - 1
        upper = level.select("side", (F.col("at") - half).alias("at"), *(F.col(c).alias(f"{c}2") for c in ("value", "least", *_SUMS)))
        level = work.write(
            level.join(upper, ["side", "at"]).select(
                "side", "at", *(F.least(c, f"{c}2").alias(c) for c in ("value", "least")), *((F.col(c) + F.col(f"{c}2")).alias(c) for c in _SUMS)
            )
        )
        levels.append(level)
    edges = found.filter(F.col("kind").isin(HEAD, TAIL))
    # A block's tail is where extents to the right leave it, and its head where those to the left do.
    side = F.when(F.col("kind") == TAIL, 1).otherwise(-1)
    moving = edges.select(
        side.alias("side"), "block", "depth", (F.col("block") * side).alias("place"),
        F.lit(None).cast("long").alias("least"), *(F.lit(0).cast("long").alias(c) for c in _SUMS),
    )
    for k in range(len(levels) - 1, -1, -1):
        ahead = levels[k].select("side", (F.col("at") - 1).alias("place"), "value", *(F.col(c).alias(f"{c}2") for c in ("least", *_SUMS)))
        step = F.coalesce(F.col("value") >= F.col("depth"), F.lit(False))
        moving = moving.join(ahead, ["side", "place"], "left").select(
            "side", "block", "depth",
            (F.col("place") + F.when(step, 1 << k).otherwise(0)).alias("place"),
            F.least("least", F.when(step, F.col("least2"))).alias("least"),
            *((F.col(c) + F.when(step, F.col(f"{c}2")).otherwise(0)).alias(c) for c in _SUMS),
        )
        if k % 4 == 0:
            moving = work.write(moving)
    # The block in which the extent ends, if it gets into it.
    stops = edges.select(
        (-side).alias("side"), (F.col("block") * -side - 1).alias("place"), "depth",
        *(F.col(c).alias(f"{c}2") for c in ("first", "least", *_SUMS)),
    )
    ended = moving.join(stops, ["side", "place", "depth"], "left")
    first = F.coalesce("first2", -F.col("place") * BLOCK)
    beyond = [first.alias("first"), F.least("least", "least2").alias("least")]
    beyond += [(F.col(c) + F.coalesce(f"{c}2", F.lit(0))).alias(c) for c in _SUMS]
    return work.write(ended.select("side", "block", "depth", F.struct(*beyond).alias("beyond")))


def _hash_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of lists, sorted by list and part, to one hash per list; no list is held."""
    import hashlib

    current, state = None, None
    for batch in batches:
        done = []
        for start, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if start == current:
                state.update(b"," + part.encode())
                continue
            if state:
                done.append((current, state.hexdigest()))
            current, state = start, hashlib.sha256(part.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["start", "ends"])
    if state:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([state.hexdigest()])], ["start", "ends"])


def _text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def trie(turns: DataFrame, convs: DataFrame, work: Workspace) -> DataFrame:
    """One row per node of the trie of ``turns`` (``conv``, ``pos``, ``digest``, ``size``), the root included; ``convs`` (``conv``, ``n``)
    has all conversations, also those without turns. See ``prefix_nodes`` for the columns."""
    places, pieces = sort_conversations(turns, convs, work)
    block = F.array_distinct(F.array(F.expr(f"no div {BLOCK}"), F.expr(f"greatest(no - 1, 0) div {BLOCK}")))
    shown = places.select(F.explode(block).alias("block"), "no", "conv", "n", "total", "lcp", "before")
    found = work.write(shown.repartition("block").sortWithinPartitions("block", "no").mapInArrow(_solve_blocks, _FOUND))
    beyond = _reach_over_blocks(found, work)
    right = beyond.filter("side = 1").select("block", "depth", F.lit(1).cast("long").alias("open_right"), F.col("beyond").alias("right"))
    left = beyond.filter("side = -1").select("block", "depth", F.lit(1).cast("long").alias("open_left"), F.col("beyond").alias("left"))

    # Each place with the node above what is new in it, or with the first place of its run of equal sequences.
    ahead = found.filter(F.col("kind") == CANDIDATE).join(right, ["block", "depth", "open_right"], "left").join(left, ["block", "depth", "open_left"], "left")
    heads = work.write(
        ahead.select(
            "no", "conv", "n", F.col("depth").alias("lcp"), "next", F.coalesce("left.first", "first").alias("first"),
            F.when(F.col("depth") >= 0, F.least("least", "left.least", "right.least")).alias("parent"),
        )
    )
    branches = heads.filter("lcp >= 0 AND lcp < n").groupBy(F.col("first").alias("no"), F.col("lcp").alias("depth")).agg(F.count(F.lit(1)).alias("branches"))
    equal = F.col("lcp") == F.col("n")
    start = F.when(equal, F.col("first")).otherwise(F.col("no"))
    runs = heads.filter(equal | (F.col("next") == F.col("n"))).select(start.alias("start"), "no", "conv")
    part = F.expr(f"(no - start) div {LIST_ROWS}")
    parts = runs.groupBy("start", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("no", "conv"))).alias("ids"))
    parts = parts.select("start", "part", F.array_join(F.transform("ids", lambda i: i["conv"].cast("string")), ",").alias("text"))
    lists = parts.repartition("start").sortWithinPartitions("start", "part").mapInArrow(_hash_lists, "start BIGINT, ends STRING")
    lists = lists.withColumnRenamed("start", "no")

    none = _text_digest(F.lit(""))
    shared = found.filter(F.col("kind") == NODE).join(right, ["block", "depth", "open_right"], "left")
    grown = {c: F.col(c) + F.coalesce(F.col(f"right.{c}"), F.lit(0)) for c in _SUMS}
    shared = shared.withColumns(grown | {"least": F.least("least", "right.least"), "piece": F.expr(f"(depth - 1) div {PIECE}")})
    # Bytes of the turns above the node's own one.
    prefix = pieces.select("conv", "piece", "start", "sums")
    at = F.col("start") + F.get("sums", ((F.col("depth") - 1) % PIECE).cast("int"))
    above = F.when(F.col("depth") > 0, at).otherwise(0)
    shared = shared.join(prefix, ["conv", "piece"], "left").withColumn("above", above)
    saved = F.col("total") - F.col("rows") * F.col("above") - (F.col("fresh") + F.col("own") - F.col("above"))
    shared = work.write(
        shared.join(branches, ["no", "depth"], "left").select(
            "no", "depth", "n", F.col("least").alias("conv_id"), F.col("rows").alias("n_convs"), "leaves", saved.alias("saved"),
            ((F.col("depth") < F.col("n")).cast("long") + F.coalesce("branches", F.lit(0))).alias("n_children"),
        )
    )
    chain = Window.partitionBy("no").orderBy("depth")
    upper = shared.withColumn("up", F.lag("conv_id").over(chain)).join(heads.select("no", "parent"), "no")
    upper = upper.withColumn("full", F.when(F.col("depth") == F.col("n"), F.col("no")))
    upper = upper.join(lists.withColumnRenamed("no", "full"), "full", "left").select(
        "conv_id", "depth", F.coalesce("up", "parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", none).alias("ends_sha256"),
    )

    # Prefixes deeper than what a place shares with either neighbour have it as their only member.
    last = shared.groupBy("no").agg(F.max_by("conv_id", "depth").alias("last_shared"))
    alone = heads.withColumn("shared", F.greatest("lcp", "next")).filter("shared < n").join(last, "no", "left")
    low, high = F.col("shared") + 1, F.col("n")
    alone = alone.withColumn("from", F.explode(F.sequence(low, high, F.lit(_CHUNK).cast("long"))))
    alone = alone.withColumn("depth", F.explode(F.sequence("from", F.least(F.col("from") + _CHUNK - 1, high))))
    over = F.when(F.col("depth") > low, F.col("conv")).when(F.col("next") > F.col("lcp"), F.col("last_shared")).otherwise(F.col("parent"))
    one = F.lit(1).cast("long")
    alone = alone.select(
        F.col("conv").alias("conv_id"), "depth", over.alias("parent_conv_id"), one.alias("n_convs"),
        (F.col("depth") < high).cast("long").alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == high, _text_digest(F.col("conv").cast("string"))).otherwise(none).alias("ends_sha256"),
    )
    return upper.unionByName(alone)


def prefix_nodes(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    donor: Column | None = None,
    head: Column | None = None,
    longest_head: int = 0,
) -> DataFrame:
    """One row per distinct prefix of turns, the empty one included: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (that
    of the prefix one turn shorter), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes below, itself included),
    ``saved_tokens`` (bytes of last turns that members below need not repeat) and ``ends_sha256`` (of the members that end here).

    With ``donor`` and ``head`` (expressions of ``conv``) conversations are spliced first, see ``splice``.
    """
    work = Workspace(conversations.sparkSession, "trie")
    turns, convs = read_turns(conversations, conv_col, turn_col, role_col, text_col, work)
    if donor is not None:
        turns, convs = splice(turns, convs, donor, head, longest_head)
        convs = work.write(convs)
    return trie(turns, convs, work)
