"""Language identification by words first, then by ever shorter character n-grams.

A word the model knows scores by its log frequency in each language. An unseen word falls back to
its character 5-grams, then 4-grams and so on down to single characters: the first length of which
any gram is known decides. The scores of all words add up, and a softmax over languages gives the
score of the best one.

Null text, or text without a letter, is ``und`` with score 0. Texts of any length are read whole.
Languages that tie go to the first by name. A model that has learned nothing answers ``und``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import free_name
from broadsheet.storage import Workspace

UNDETERMINED = "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LONGEST = 5
SMOOTHING = 0.5
# Most vectors of unseen words that one task keeps for reuse.
REMEMBERED = 100_000


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams; for n over 1 the word's borders count as a character."""
    padded = word if n == 1 else f"_{word}_"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies per language: one matrix, with a row for each of ``pieces``: the known words, ``words_known``
    in number, then the known grams. ``cut`` counts the pieces of the sample that found no room.

    The pieces are an Arrow column, also on their way to the tasks; the look-ups are made where they are used, which
    is not the driver.
    """

    languages: list[str]
    pieces: pa.Array
    words_known: int
    logs: np.ndarray
    cut: int = 0
    _unseen: dict[str, list[int]] = field(default_factory=dict, repr=False)

    @cached_property
    def words(self) -> dict[str, int]:
        return {piece: i for i, piece in enumerate(self.pieces[: self.words_known].to_pylist())}

    @cached_property
    def grams(self) -> dict[str, int]:
        return {piece: i for i, piece in enumerate(self.pieces[self.words_known :].to_pylist(), self.words_known)}

    def rows(self, word: str) -> list[int]:
        """Rows whose mean is the evidence of a word: its own, or those of its longest known grams."""
        row = self.words.get(word)
        if row is not None:
            return [row]
        found = self._unseen.get(word)
        if found is None:
            found = []
            for n in range(LONGEST, 0, -1):
                found = [r for r in map(self.grams.get, grams_of(word, n)) if r is not None]
                if found:
                    break
            if len(self._unseen) >= REMEMBERED:
                self._unseen.clear()
            self._unseen[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = Counter(words_of(text))
        if not counts or not self.languages:
            return UNDETERMINED, 0.0
        rows: list[int] = []
        weights: list[float] = []
        for word, times in counts.items():
            own = self.rows(word)
            rows += own
            weights += [times / len(own)] * len(own) if own else []
        total = np.array(weights) @ self.logs[rows] if rows else np.zeros(len(self.languages))
        odds = np.exp(total - total.max())
        best = int(np.argmax(odds))
        return self.languages[best], float(odds[best] / odds.sum())


def _count_words(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words with their numbers in each language, for one batch at a time."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for language, text in zip(batch["lang"], batch["text"]):
            counts.setdefault(language, Counter()).update(words_of(text))
        rows = [(language, word, times) for language, own in counts.items() for word, times in own.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["lang", "word", "times"]).astype({"times": "int64"})


def _count_grams(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Grams of counted words, with their numbers."""
    for batch in batches:
        counts: dict[str, Counter] = {}
        for language, word, times in zip(batch["lang"], batch["word"], batch["times"]):
            own = counts.setdefault(language, Counter())
            for n in range(1, LONGEST + 1):
                for gram in grams_of(word, n):
                    own[gram] += times
        rows = [(language, len(gram), gram, times) for language, own in counts.items() for gram, times in own.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["lang", "n", "piece", "times"]).astype({"n": "int32", "times": "int64"})


def sample_by_language(training: DataFrame, per_language: int) -> tuple[DataFrame, list[str]]:
    """About ``per_language`` different texts of each language, chosen by the hash of the text.

    The share of hashes that is taken follows from the number of different ones, so no task ever
    sees more than a bounded number of texts, and a language with fewer texts is taken whole,
    however many copies it holds; copies of one text fall together before the shuffle. The shares are
    a table with a row for each language, whose written size decides how it is joined.
    """
    scale = 1 << 20
    hashed = training.withColumn("hash", F.xxhash64("text"))
    different = hashed.select("lang", "hash").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    share = F.least(F.lit(scale), F.ceil(F.lit(scale * per_language) / F.col("texts"))).alias("share")
    shares = Workspace(training.sparkSession, "shares").write(different.select("lang", share))
    chosen = hashed.join(shares, "lang").filter(F.pmod("hash", F.lit(scale)) < F.col("share"))
    texts = chosen.groupBy("lang", "hash").agg(F.first("text").alias("text"))
    return texts, sorted(row["lang"] for row in shares.select("lang").collect())


def _most_frequent(counts: DataFrame, words: int | None, grams: int | None) -> DataFrame:
    """The rows of ``counts`` whose piece is among the most frequent ones of any language: each language has
    room for as many words and as many grams, whatever the others hold. None is room for all."""
    kind = F.col("n") > 0
    first = Window.partitionBy("lang", kind).orderBy(F.col("times").desc(), "n", "piece")
    place = counts.withColumn("place", F.row_number().over(first))
    room = [F.lit(True) if size is None else F.col("place") <= size for size in (grams, words)]
    kept = place.filter((kind & room[0]) | (~kind & room[1])).select("n", "piece").distinct()
    return counts.join(kept, ["n", "piece"], "left_semi")


def learn(
    training: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 2_000,
    vocabulary: int | None = 50_000,
    grams: int | None = 60_000,
) -> LanguageModel:
    """A model from the rows that have text and language.

    The fit reads about ``per_language`` texts of each language. The ``vocabulary`` most frequent words and the
    ``grams`` most frequent grams of each language make up the model, so that a language with few or short
    texts keeps its own, however much the others hold; None keeps all pieces of the sample. ``cut`` in the
    model tells how many were left out. Counting is a Spark aggregation; only the model itself reaches the driver.
    """
    pairs = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sample, languages = sample_by_language(pairs.filter("lang IS NOT NULL AND text IS NOT NULL"), per_language)
    if not languages:
        return LanguageModel([], pa.array([], pa.large_string()), 0, np.zeros((0, 0)))
    work = Workspace(training.sparkSession, "language")
    counted = sample.select("lang", "text").mapInPandas(_count_words, "lang STRING, word STRING, times BIGINT")
    words = work.write(counted.groupBy("lang", "word").agg(F.sum("times").alias("times")))
    # Grams come from the counted words: each different word is taken apart once for a language.
    parts = words.mapInPandas(_count_grams, "lang STRING, n INT, piece STRING, times BIGINT")
    both = words.select("lang", F.lit(0).alias("n"), F.col("word").alias("piece"), "times").union(parts)
    counts = work.write(both.groupBy("lang", "n", "piece").agg(F.sum("times").alias("times")))
    totals = {(row["lang"], row["n"]): row["times"] for row in counts.groupBy("lang", "n").agg(F.sum("times").alias("times")).collect()}
    different = counts.select("n", "piece").distinct().count()
    # As Arrow columns all the way: as Python rows the pieces would take many times their size in the driver.
    kept = _most_frequent(counts, vocabulary, grams).select("lang", "n", "piece", "times").orderBy("n", "piece").toArrow()
    each = kept["piece"].cast(pa.large_string()).combine_chunks()
    length = kept["n"].to_numpy()
    first = np.ones(len(each), bool)
    first[1:] = (length[1:] != length[:-1]) | pc.not_equal(each[1:], each[:-1]).to_numpy(zero_copy_only=False)
    pieces, n = each.filter(pa.array(first)), length[first]
    times = np.zeros((len(pieces), len(languages)))
    place = pc.index_in(kept["lang"], value_set=pa.array(languages, kept["lang"].type)).to_numpy()
    times[np.cumsum(first) - 1, place] = kept["times"].to_numpy()
    sizes = np.bincount(n, minlength=LONGEST + 1)
    total = np.array([[totals.get((language, size), 0) for language in languages] for size in range(LONGEST + 1)], float)
    logs = np.log((times + SMOOTHING) / (total[n] + SMOOTHING * sizes[n][:, None]))
    return LanguageModel(languages, pieces, int(sizes[0]), logs, different - len(pieces))


def share(df: DataFrame, model: LanguageModel):
    """The model's fields as a broadcast; ``LanguageModel(*value)`` in a task."""
    return df.sparkSession.sparkContext.broadcast(
        (model.languages, model.pieces, model.words_known, model.logs)
    )


def identify(df: DataFrame, model: LanguageModel, text_col: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """df with the predicted language and its score; one narrow pass."""
    shared = share(df, model)

    @F.pandas_udf("lang STRING, score DOUBLE")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = LanguageModel(*shared.value)
        for texts in batches:
            yield pd.DataFrame([own.predict(text) for text in texts], columns=["lang", "score"])

    found = free_name(df, "_found")
    predicted = df.withColumn(found, predict(F.col(text_col)))
    return predicted.withColumns({lang: F.col(found)["lang"], score: F.col(found)["score"]}).drop(found)


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that no model learns from; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_identified(
    df: DataFrame, model: LanguageModel, text_col: str = "text", languages: Collection[str] | None = None
) -> DataFrame:
    """The rows in one of the languages, all columns as they are; None asks for any, and only what ``identify``
    calls ``und`` goes.

    No score is asked for: that of a text without evidence is 1 / number of languages, so any bound
    would make its fate depend on how many were learned.
    """
    shared = share(df, model)
    wanted = None if languages is None else frozenset(languages)

    @F.pandas_udf("boolean")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = LanguageModel(*shared.value)
        for texts in batches:
            found = [own.predict(text)[0] for text in texts]
            yield pd.Series([name != UNDETERMINED and (wanted is None or name in wanted) for name in found], dtype=bool)

    return df.filter(identified(F.col(text_col)))
