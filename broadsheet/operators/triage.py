"""Mirror triage: of articles with near-identical titles only the most authoritative stays.

Two titles are mirrors if the Jaccard similarity of their distinct words is 0.8 or more. Articles
are walked from most to least authoritative (government hosts, tier, newest date, order); one is
dropped if it mirrors an article already kept. Titles without words mirror nothing.

The walk runs as rounds over tables, exact and without comparing all pairs of a group:

1. Equal word sets fall together in a partial aggregation; only the best article of each can
   stay. Sets of up to three words have no other mirrors than equal sets.
2. Each set gets keys such that any two mirrors share one. For every size that a partner can have,
   the two sizes fix how many words the mirrors must share. Where the larger set may have one word
   more than that, the keys are the sets themselves and the sets without one word, so that sets
   with a common key are mirrors. Otherwise they are combinations of three of the rarest words
   (of two sets that share enough words, the beginnings in a common word order share three).
   Sets of more than 40 words use pairs of their rarest words, whatever the partner's size, and those
   of more than 200, for which pairs become too many, single words of their rarest fifth.
3. In each round the PIVOTS most authoritative live sets of a key are compared with the key's
   members of the partner size. A set whose earlier members were all compared and none of which is
   similar is kept; a set similar to a kept one is dropped; the others go on to the next round. A
   key shared by any number of sets costs PIVOTS comparisons per member.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions.text import bind, title_words
from broadsheet.operators.lookup import retain
from broadsheet.operators.rank import date_number, number_top, top
from broadsheet.storage import Workspace

PIVOTS = 8
# A word in more than one in FREQUENT of the word occurrences sorts behind the others, by count.
FREQUENT = 10_000
# Sets up to BY_SIZE words have keys per partner size; larger ones up to BY_PAIR, and those that can
# have such partners, have pairs of words as keys; the largest and their partners single words.
BY_SIZE = 40
PAIRS_FROM = 33
BY_PAIR = 200
SINGLES_FROM = 161


def authority(domain: Column) -> Column:
    """0 for government and military hosts, 1 for others."""
    return F.when(domain.rlike(r"(^|\.)(gov|mil|gov\.cn)$"), 0).otherwise(1)


def authority_order() -> Column:
    """One comparable value: smaller is more authoritative, ``ord`` makes it unique."""
    return F.struct(
        authority(F.col("domain")).alias("official"),
        F.col("tier"),
        (-date_number(F.col("seendate"))).alias("newest"),
        F.col("ord"),
    )


def similar(one: Column, other: Column) -> Column:
    """Jaccard >= 0.8 of two word sets, in whole numbers."""
    common = F.size(F.array_intersect(one, other))
    return common * 18 >= (F.size(one) + F.size(other)) * 8


def _rare_first(sets: DataFrame) -> DataFrame:
    """Put the words of each set into one common order in which frequent words come last."""
    words = sets.select("rank", F.explode("words").alias("word"))
    total = sets.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    # At most FREQUENT words can pass, as the counts sum up to the total: safe to broadcast.
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") * FREQUENT > total)
    counted = words.join(F.broadcast(frequent), "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")))
    return counted.groupBy("rank").agg(F.transform(ordered, lambda pair: pair["word"]).alias("words"))


def _triples(prefix: Column, tag: list[Column]) -> Column:
    """Hashes of all three-word combinations of a short list of words."""
    n = F.size(prefix)

    def third(i: Column, j: Column) -> Column:
        first, second = F.element_at(prefix, i), F.element_at(prefix, j)
        return F.transform(F.slice(prefix, j + 1, n), lambda word: F.xxhash64(*tag, first, second, word))

    def second(i: Column) -> Column:
        return F.flatten(F.transform(F.sequence(i + 1, n - 1), lambda j: third(i, j)))

    return F.flatten(F.transform(F.sequence(F.lit(1), n - 2), second))


def _pairs(prefix: Column, tag: list[Column]) -> Column:
    """Hashes of all two-word combinations of a list of words."""
    n = F.size(prefix)

    def second(i: Column) -> Column:
        return F.transform(F.slice(prefix, i + 1, n), lambda word: F.xxhash64(*tag, F.element_at(prefix, i), word))

    return F.flatten(F.transform(F.sequence(F.lit(1), n - 1), second))


def _keys_for(words: Column, n: Column, partner: Column) -> Column:
    """Keys that a set of n words shares with each of its mirrors of ``partner`` words."""
    smaller, larger = F.least(n, partner), F.greatest(n, partner)
    tag = [smaller, larger]
    common = F.ceil((n + partner) * 8 / 18).cast("int")
    spare = n - common
    without_one = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.xxhash64(*tag, F.concat(F.slice(words, F.lit(1), i - 1), F.slice(words, i + 1, n))),
    )
    return (
        F.when(larger - common > 1, bind(F.slice(words, F.lit(1), spare + 3), lambda prefix: _triples(prefix, tag)))
        .when(spare == 0, F.array(F.xxhash64(*tag, words)))
        .otherwise(without_one)
    )


def _keyed(sets: DataFrame) -> DataFrame:
    """rank, words, key, size, partner: one row per key of each set of four words or more."""
    words, n = F.col("words"), F.size("words")
    fewest = F.ceil(n * 4 / 5).cast("int")
    most = F.least(F.floor(n * 5 / 4).cast("int"), F.lit(BY_SIZE))

    def of_partner(m: Column) -> Column:
        keys = F.array_distinct(_keys_for(words, n, m))
        return F.transform(keys, lambda key: F.struct(key.alias("key"), n.alias("size"), m.alias("partner")))

    by_size = F.when(n <= BY_SIZE, F.flatten(F.transform(F.sequence(fewest, most), of_partner)))
    any_size = F.lit(0)

    def of_any(keys: Column) -> Column:
        return F.transform(keys, lambda key: F.struct(key.alias("key"), any_size.alias("size"), any_size.alias("partner")))

    # Two mirrors share at least ``fewest`` words, so their beginnings share one, or two if a word longer.
    beginning = F.slice(words, F.lit(1), n - fewest + 2)
    pairs = F.when(n.between(PAIRS_FROM, BY_PAIR), of_any(bind(beginning, lambda prefix: _pairs(prefix, [any_size]))))
    singles = F.when(n >= SINGLES_FROM, of_any(F.transform(F.slice(words, F.lit(1), n - fewest + 1), lambda word: F.xxhash64(word))))
    nothing = F.array().cast("array<struct<key: bigint, size: int, partner: int>>")
    keys = F.concat(*(F.coalesce(part, nothing) for part in (by_size, pairs, singles)))
    return sets.select("rank", "words", F.explode(keys).alias("key")).select("rank", "words", "key.*")


def kept_sets(sets: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """The ``rank`` values that stay, from distinct word sets with columns rank and words."""
    work = Workspace(sets.sparkSession, "triage")
    sets = work.write(sets)
    alone = sets.filter(F.size("words") < 4).select("rank")
    keyed = _keyed(work.write(_rare_first(sets.filter(F.size("words") >= 4))))
    # A key leads nowhere without a member of the partner size; a set without shared keys is kept.
    sizes = keyed.groupBy("key").agg(
        F.min("size").alias("low"),
        F.max("size").alias("high"),
        F.max("partner").alias("partner"),
        F.count(F.lit(1)).alias("n"),
    )
    one_size = (F.col("high") == F.col("partner")) & (F.col("n") > 1)
    shared = sizes.filter((F.col("low") != F.col("high")) | one_size)
    live, rows = work.write_counted(keyed.join(shared.select("key"), "key", "left_semi"))
    crowd = live.select("rank").distinct()
    kept_parts = [alone, sets.filter(F.size("words") >= 4).select("rank").join(crowd, "rank", "left_anti")]
    while rows:
        best = Window.partitionBy("key", "size").orderBy("rank")
        leads = live.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= pivots)
        leads = leads.groupBy("key", F.col("size").alias("partner")).agg(
            F.array_sort(F.collect_list(F.struct("rank", "words"))).alias("leads")
        )
        # Outer: the partners of a key may all be decided while the set itself is not.
        placed = live.join(leads, ["key", "partner"], "left")
        last = F.element_at("leads", -1)["rank"]
        open_end = F.coalesce((F.size("leads") == pivots) & (F.col("rank") > last), F.lit(False))
        before = F.filter(
            "leads", lambda lead: (lead["rank"] < F.col("rank")) & similar(lead["words"], F.col("words"))
        )
        compared = placed.select(
            "rank", open_end.alias("open_end"), F.transform(before, lambda lead: lead["rank"]).alias("mirrors")
        )
        state = work.write(
            compared.groupBy("rank").agg(
                F.max("open_end").alias("open_end"),
                F.array_distinct(F.flatten(F.collect_list("mirrors"))).alias("mirrors"),
            )
        )
        kept = work.write(state.filter(~F.col("open_end") & (F.size("mirrors") == 0)).select("rank"))
        kept_parts.append(kept)
        edges = state.select("rank", F.explode("mirrors").alias("mirror"))
        dropped = edges.join(kept.withColumnRenamed("rank", "mirror"), "mirror", "left_semi").select("rank").distinct()
        decided = kept.unionByName(dropped)
        live, rows = work.write_counted(live.join(decided, "rank", "left_anti").select(*live.columns))
    return reduce(DataFrame.unionByName, kept_parts)


# A numbered list (the articles with ``pos`` from 0) to the positions that stay (``index``).
Reviewer = Callable[[DataFrame], DataFrame]


def triage(df: DataFrame, cap: int | None = None, pivots: int = PIVOTS, reviewer: Reviewer | None = None) -> DataFrame:
    """Articles without mirrors of more authoritative ones. With a cap only the first ``cap``
    articles of the ranking are looked at and the others are lost, as in an interactive review.
    A reviewer takes the place of the rules: positions listed twice count once here, and ones
    beyond the list not at all."""
    if reviewer is not None:
        numbered = number_top(df, cap).withColumn("pos", F.col("idx") - 1)
        chosen = reviewer(numbered.drop("idx")).select("index").distinct()
        return retain(numbered, chosen).select(*df.columns)
    items = top(df, cap)
    worded = items.select(authority_order().alias("rank"), title_words(F.col("title")).alias("words"))
    sets = worded.filter(F.size("words") > 0).groupBy("words").agg(F.min("rank").alias("rank"))
    kept = kept_sets(sets, pivots).select(F.col("rank.ord").alias("ord"))
    wordless = worded.filter(F.size("words") == 0).select(F.col("rank.ord").alias("ord"))
    return items.join(kept.unionByName(wordless), "ord", "left_semi")
