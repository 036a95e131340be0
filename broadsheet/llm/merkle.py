"""Merkle manifest of a dataset: per group a tree of arity three, and one tree over the groups.

The digest of a node is the SHA-256, as lower-case hex, of its inputs joined: of the encoded fields
for a leaf, of the children's hex digests for any other node. Leaves of a group lie in a total order;
while more than one node is left, each run of three neighbours (the last one may be shorter, even of
one) becomes one node. The roots of the groups, in the order of the groups, are then leaves of the
tree that ends in the root of the dataset.

Trees are climbed by window functions. The node that covers leaf ``pos`` on level k of its tree
belongs to the row at the first of its leaves, so neighbouring nodes are always 3^k rows apart:
``lag`` and ``lead`` by 3^k and 2 * 3^k read the siblings, masked by the slot in the run and the run's
length, and the rows of first children hash their parents. Windows cover blocks of 3^6 leaves, which
are whole subtrees, so a group of any size is spread over all tasks; the roots of the blocks are the
leaves of the next tier.

Defined cases: a null field is encoded as ``-`` and differs from an empty one; a null group is a group
of its own, the first; null orders come first, and rows that tie in the order are ordered by their
leaves, so equal rows are leaves of their own; an empty table has no rows and no root; a lone leaf is
its group's root, a lone group's root the root. Columns that are not named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.rows import number_sorted
from broadsheet.storage import Workspace

ARITY = 3
LEVELS = 6
BLOCK = ARITY**LEVELS
_PATH = "array<struct<left: string, right: string>>"


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Each field as ``-`` if null, else its length in UTF-8 bytes, a colon and its value."""
    texts = [field.cast("string") for field in fields]
    return sha256_hex(
        F.concat(*(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts))
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, leaf, lambda node, level: sha256_hex(F.concat(level["left"], node, level["right"])))


def path_digest(path: Column) -> Column:
    """The SHA-256 of all siblings, from the leaf to the root, left to right."""
    return sha256_hex(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""))


def _climb_block(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``grp``, ``pos``, ``n``, ``digest``) with ``blk``, ``path`` (siblings on the next six levels, as
    far as the group has them) and, on the first row of each block, ``top`` (the block's node)."""
    rows = nodes.withColumn("blk", F.expr(f"pos div {BLOCK}")).withColumn("_node0", F.col("digest"))
    block = Window.partitionBy("grp", "blk").orderBy("pos")
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    for level in range(LEVELS):
        step = ARITY**level
        node = F.col(f"_node{level}")
        width = F.expr(f"(n + {step - 1}) div {step}")
        index = F.expr(f"pos div {step}")
        slot = index % ARITY
        run = F.least(F.lit(ARITY), width - (index - slot))
        before, before2 = F.lag(node, step).over(block), F.lag(node, 2 * step).over(block)
        after, after2 = F.lead(node, step).over(block), F.lead(node, 2 * step).over(block)
        left = F.when(slot == 0, "").when(slot == 1, before).otherwise(F.concat(before2, before))
        right = F.when(run - slot == 1, "").when(run - slot == 2, after).otherwise(F.concat(after, after2))
        first_leaf = F.col("pos") % step == 0
        rows = rows.withColumn("_own", F.when(first_leaf & (width > 1), F.struct(left.alias("left"), right.alias("right"))))
        parent = F.when(width > 1, sha256_hex(F.concat(node, F.col("_own.right")))).otherwise(node)
        rows = rows.withColumns(
            {
                # A leaf's node on this level has its siblings in the row of its first leaf, the last one before.
                f"_level{level}": F.last("_own", ignorenulls=True).over(so_far),
                f"_node{level + 1}": F.when(F.col("pos") % (step * ARITY) == 0, parent),
            }
        ).drop("_own")
    path = F.filter(F.array(*(f"_level{level}" for level in range(LEVELS))), lambda level: level.isNotNull())
    return rows.select(*nodes.columns, "blk", path.cast(_PATH).alias("path"), F.col(f"_node{LEVELS}").alias("top"))


def climb(nodes: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes`` (``grp``, ``pos`` from 0 without gaps, ``n`` in the group, ``digest``, and any more).

    The nodes with ``path``, all siblings up to the group's root, and a table of ``grp``, ``root``.
    """
    tiers = []
    tier = nodes
    while True:
        climbed = work.write(_climb_block(tier))
        tiers.append(climbed)
        tops = climbed.filter(f"pos % {BLOCK} = 0")
        tier = tops.select("grp", F.col("blk").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("digest"))
        if tier.filter("n > 1").isEmpty():
            break
    roots = tier.select("grp", F.col("digest").alias("root"))
    # From the top down each tier's path goes on with that of the block above it. A block has 729 rows at most.
    done = tiers.pop().drop("blk", "top")
    while tiers:
        above = work.write(done.select("grp", F.col("pos").alias("blk"), F.col("path").alias("_rest")))
        below = tiers.pop().join(above, ["grp", "blk"])
        done = below.withColumn("path", F.concat("path", "_rest")).drop("blk", "top", "_rest")
    return done, roots


def manifest(rows: DataFrame, fields: list[str], group_col: str, order_col: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per row: ``key`` (its order column), ``leaf``, ``path``, ``subroot``, ``root`` and the ``extra`` columns,
    which are made of the row's own columns. ``path`` holds structs of the siblings left and right."""
    work = Workspace(rows.sparkSession, "merkle")
    extra = extra or {}
    # The letter before the name keeps a null group apart, and before all others.
    group = F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit("n"))
    leaves = rows.select(
        group.alias("grp"),
        F.col(order_col).alias("key"),
        leaf_digest([F.col(name) for name in fields]).alias("digest"),
        *(column.alias(name) for name, column in extra.items()),
    )
    numbered = number_sorted(leaves, [F.col("grp"), F.col("key").asc_nulls_first(), F.col("digest")], work, "no")
    # A table of its own, so that the join is between two exchanges and a large group can be split.
    groups = work.write(numbered.groupBy("grp").agg(F.min("no").alias("start"), F.count(F.lit(1)).alias("n")))
    placed = numbered.join(groups, "grp").withColumn("pos", F.col("no") - F.col("start")).drop("no", "start")
    paths, subroots = climb(placed, work)
    ordered = number_sorted(subroots, [F.col("grp")], work, "pos")
    count = ordered.count()
    tops = ordered.select(F.lit(0).alias("grp"), "pos", F.lit(count).cast("long").alias("n"), F.col("root").alias("digest"), F.col("grp").alias("of"))
    upper, roots = climb(tops, work)
    # One row, joined by its key, which is the same everywhere.
    groups = work.write(
        upper.join(F.broadcast(roots), "grp").select(F.col("of").alias("grp"), F.col("digest").alias("subroot"), F.col("path").alias("_upper"), "root")
    )
    found = paths.join(groups, "grp")
    return found.select(
        "key", F.col("digest").alias("leaf"), F.concat("path", "_upper").alias("path"), "subroot", "root", *extra
    )


def verify(found: DataFrame, leaf: Column) -> DataFrame:
    """``found`` of ``manifest`` with ``proof_sha256``, ``folded_root`` (from ``leaf`` and the siblings) and ``verified``."""
    folded = found.withColumn("folded_root", fold(leaf, F.col("path")))
    return folded.withColumns(
        {"proof_sha256": path_digest(F.col("path")), "verified": F.col("folded_root") == F.col("root")}
    )
