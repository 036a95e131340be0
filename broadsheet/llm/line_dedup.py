"""Cross-site boilerplate lines, by the number of distinct sites a line stands on.

HyperLogLog sketches of sites, one per line, merge by aggregation. Lines whose estimate is clearly
below or above the threshold are decided by it; those near it get an exact distinct count. Lines
on ``min_sites`` or more sites are removed from every document; all other lines stay, in order.

Lines are what stands between line feeds, compared as they are. Lines of nothing but white space
are never removed. Null text is kept as null and has no lines; a null site counts as a site. The
main path is DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import digest, row_key
from broadsheet.storage import Workspace

MIN_SITES = 5
# Log 2 of the buckets of a sketch; its relative standard error is about 1.04 / sqrt(2 ** LOG_K).
LOG_K = 10
# Estimates within this many standard errors of the threshold are counted exactly.
MARGIN = 6.0


def line_key(line: Column) -> Column:
    """128 bits of a line."""
    return F.unhex(F.md5(line.cast("binary")))


def lines_of(docs: DataFrame) -> DataFrame:
    """``key``, ``site``, ``pos``, ``line`` (its key) for each line of ``docs`` that is not blank."""
    line = F.posexplode(F.split("text", "\n", -1)).alias("pos", "words")
    return docs.select("key", "site", line).filter(F.col("words").rlike(r"[^\x20\x09-\x0D]")).select(
        "key", "site", "pos", line_key(F.col("words")).alias("line")
    )


def boilerplate(lines: DataFrame, min_sites: int, log_k: int = LOG_K, margin: float = MARGIN) -> DataFrame:
    """The lines (``line``) on ``min_sites`` or more distinct sites. ``lines``: ``line``, ``site``; read twice."""
    work = Workspace(lines.sparkSession, "lines")
    site = F.coalesce(F.concat(F.lit("s"), F.col("site").cast("string")), F.lit("n"))
    # A line is listed once for each site and map task before sketches are made of it.
    sketches = lines.groupBy("line").agg(
        F.hll_sketch_agg(site, F.lit(log_k)).alias("sketch"), F.count(F.lit(1)).alias("rows")
    )
    # A line of fewer rows than sites are asked for needs no estimate.
    estimated = work.write(
        sketches.filter(F.col("rows") >= min_sites).select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    )
    error = margin * 1.04 / 2 ** (log_k / 2)
    # Counting is exact where the true number could lie on the other side of the threshold.
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    clear = estimated.filter(F.col("sites") > high).select("line")
    near = estimated.filter(F.col("sites").between(low, high)).select("line")
    exact = (
        lines.select("line", site.alias("site")).join(near, "line", "left_semi").distinct()
        .groupBy("line").agg(F.count(F.lit(1)).alias("sites")).filter(F.col("sites") >= min_sites).select("line")
    )
    return work.write(clear.union(exact))


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    log_k: int = LOG_K,
) -> DataFrame:
    """One row per row of docs: the id as ``id``, ``n_lines``, ``n_removed`` and ``text``, what is left of it."""
    work = Workspace(docs.sparkSession, "boilerplate")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.col(site_col).alias("site"),
        row_key(F.col(id_col), F.col(text_col)).alias("key"),
    )
    lines = work.write(lines_of(rows))
    common = boilerplate(lines, min_sites, log_k)
    # Rows that agree in id and text share a key and lose the same lines: a set of positions.
    removed = lines.join(common, "line", "left_semi").groupBy("key").agg(F.collect_set("pos").alias("removed"))
    marked = rows.select("id", "text", "key").join(removed, "key", "left")
    all_lines = F.split("text", "\n", -1)
    # Positions that stay, by a hashed difference, and then their lines, by place: linear in the lines of a text. The
    # lines are bound, as a lambda that names the split itself would split the text for each of them.
    stay = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("removed"))
    rebuilt = F.transform(F.array(all_lines), lambda lines: F.array_join(F.transform(stay, lambda pos: F.get(lines, pos)), "\n"))
    left = F.get(rebuilt, F.lit(0))
    return marked.select(
        "id",
        F.coalesce(F.size(F.when(F.col("text").isNotNull(), all_lines)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.when(F.col("removed").isNotNull(), F.col("removed"))), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(left).alias("text"),
    )


def report(cleaned: DataFrame) -> DataFrame:
    """The result with the text's SHA-256 in place of the text."""
    return cleaned.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", digest(F.col("text")).alias("text_sha256"))
