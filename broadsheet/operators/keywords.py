"""Keywords from a table of any size, found as substrings of texts without comparing all texts with all keywords.

Each keyword is looked for by one piece of it: of its runs of four characters the one that the fewest texts hold.
Texts meet keywords by equality on that piece, and a substring test decides the candidates. A keyword shorter
than a piece is a piece itself; one with a piece that no text holds occurs nowhere and is not looked for.

Case is ignored, as in ``filters.filter_keywords``. Null and empty keywords find nothing, repeated ones count
once, null texts hold nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import bind
from broadsheet.storage import Workspace

PIECE = 4


def _pieces(text: Column, lengths: Sequence[int]) -> Column:
    """Hashes of the different runs of characters of the given lengths. A look-ahead finds the one at each
    place, so the work is linear in the text; equal hashes of different runs only cost a test."""
    runs = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]
    return F.array_distinct(F.transform(F.concat(*runs), lambda run: F.xxhash64(run)))


def _rarest_pieces(words: DataFrame, texts: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``keyword`` and ``piece``: of each keyword that may occur, the piece that the fewest texts hold."""
    # Counted in each task before anything is shuffled: a piece of every text is one row a task.
    counts = texts.select(F.explode(_pieces(F.col("text"), lengths)).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    parts = [words.filter(F.least(F.length("keyword"), F.lit(PIECE)) == n).select("keyword", F.explode(_pieces(F.col("keyword"), [n])).alias("piece")) for n in lengths]
    each = parts[0]
    for part in parts[1:]:
        each = each.unionByName(part)
    found = each.join(counts, "piece", "left").groupBy("keyword").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("piece"))).alias("best")
    )
    return found.filter("best.n > 0").select("keyword", "best.piece")


def keyword_hits(
    df: DataFrame, keywords: DataFrame, columns: Sequence[str] = ("title", "url"), id_col: str = "ord", keyword_col: str = "keyword"
) -> DataFrame:
    """``id_col``, ``field`` and ``keywords`` (upper-cased, sorted) for each text that holds any.

    ``id_col`` is unique. The texts are read twice for their pieces and once for the test; a text moves at most
    once, together with its candidates. The table of chosen pieces, one row a keyword, is broadcast if the
    optimizer finds it small enough, else both sides are joined by piece.
    """
    work = Workspace(df.sparkSession, "keywords")
    upper = F.upper(F.col(keyword_col).cast("string")).alias("keyword")
    words = work.write(keywords.select(upper).filter("keyword <> ''").distinct())
    lengths = sorted(row["n"] for row in words.select(F.least(F.length("keyword"), F.lit(PIECE)).alias("n")).distinct().collect())
    fields = F.array(*(F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("text")) for name in columns))
    texts = df.select(F.col(id_col).alias("id"), F.explode(fields).alias("t")).select("id", "t.field", F.upper("t.text").alias("text"))
    texts = texts.filter("text <> ''")
    named = F.col("id").alias(id_col)
    if not lengths:
        return texts.limit(0).select(named, "field", F.array(F.lit("")).alias("keywords"))
    chosen = work.write(_rarest_pieces(words, texts, lengths))
    placed = texts.select("id", "field", F.explode(_pieces(F.col("text"), lengths)).alias("piece"))
    # The pieces of a text are in one task, so its candidates are gathered there, at most one per keyword.
    candidates = placed.join(chosen, "piece").groupBy("id", "field").agg(F.collect_set("keyword").alias("candidates"))
    held = F.array_sort(bind(F.col("text"), lambda text: F.filter("candidates", lambda word: text.contains(word))))
    # Exploding one array keeps the filter behind the test, which would else run twice.
    tested = texts.join(candidates, ["id", "field"]).select(named, "field", F.explode(F.array(held)).alias("keywords"))
    return tested.filter(F.size("keywords") > 0)


def filter_keyword_table(
    df: DataFrame, keywords: DataFrame, columns: Sequence[str] = ("title", "url"), id_col: str = "ord", keyword_col: str = "keyword"
) -> DataFrame:
    """Rows with any keyword of the table as a substring of any of the columns; as ``filters.filter_keywords``."""
    return df.join(keyword_hits(df, keywords, columns, id_col, keyword_col).select(id_col), id_col, "left_semi").select(*df.columns)
