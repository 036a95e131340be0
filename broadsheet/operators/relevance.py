"""Relevance of articles: a scorer adds ``is_relevant`` and ``reasoning``; YES rows stay."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.text import is_yes
from broadsheet.operators.rank import top
from broadsheet.settings import Settings
from broadsheet.storage import Workspace

Scorer = Callable[[DataFrame], DataFrame]
# A word is common if it is one in so many of all words of the examples, or more.
COMMON = 100_000


def _matches(settings: Settings) -> list[tuple[Column, int, str]]:
    text = F.lower(F.concat_ws(" ", "title", "reasoning"))
    return [(text.contains(rule.keyword.lower()), rule.weight, rule.keyword) for rule in settings.relevance_rules]


def rule_scorer(settings: Settings) -> Scorer:
    """Sum of the weights of the keywords in title and whole snippet; YES from the threshold on.
    The reasoning becomes the matched keywords, sorted. Built-in expressions only."""

    def score(df: DataFrame) -> DataFrame:
        total, names = F.lit(0), []
        for hit, weight, keyword in sorted(_matches(settings), key=lambda match: match[2]):
            total = total + F.when(hit, weight).otherwise(0)
            names.append(F.when(hit, keyword))
        answer = F.when(total >= settings.relevance_threshold, "YES").otherwise("NO")
        return df.withColumns(
            {"score": total, "is_relevant": answer, "reasoning": F.concat_ws(", ", *names)}
        )

    return score


def fit_relevance_model(examples: DataFrame, features: int = 1 << 16) -> PipelineModel:
    """Fit a text classifier on examples with ``text`` and ``label`` (1 = relevant)."""
    stages = [
        RegexTokenizer(inputCol="text", outputCol="words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=features),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol="label", featuresCol="features", maxIter=20, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(examples)


def model_scorer(model: PipelineModel) -> Scorer:
    """A fitted classifier as a scorer over title and whole snippet."""

    def score(df: DataFrame) -> DataFrame:
        text = df.withColumn("text", F.concat_ws(" ", "title", "reasoning"))
        scored = model.transform(text).withColumn("is_relevant", F.when(F.col("prediction") == 1.0, "YES").otherwise("NO"))
        return scored.withColumn("reasoning", F.lit("classifier")).select(*df.columns, "is_relevant")

    return score


@dataclass(frozen=True)
class WordModel:
    """Words with their log likelihood ratio as a table (``word``, ``ratio``, ``common``), the ratio of words never seen,
    and the log odds of the labels. Common words make up one in ``COMMON`` of all or more, so there are ``COMMON`` at most."""

    ratios: DataFrame
    unseen: Column
    prior: Column


def _words(text: Column) -> Column:
    return F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]+)"), F.lit(1)))


def fit_word_model(examples: DataFrame) -> WordModel:
    """Multinomial naive Bayes with one added to each count, fitted by counting words of ``text`` by ``label``
    (1 = relevant). The vocabulary stays a table, of any size; only totals reach the driver."""
    work = Workspace(examples.sparkSession, "words")
    yes = F.col("label") == 1
    counts = work.write(
        examples.select("label", _words(F.col("text")).alias("word")).groupBy("word").agg(
            F.count_if(yes).alias("yes"), F.count_if(~yes).alias("no")
        )
    )
    total = counts.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"), F.count(F.lit(1)).alias("words")).first()
    documents = examples.agg(F.count_if(yes).alias("yes"), F.count_if(~yes).alias("no")).first()
    yes_total, no_total = ((total[side] or 0) + total["words"] + 1 for side in ("yes", "no"))
    ratio = F.log((F.col("yes") + 1) / F.lit(float(yes_total))) - F.log((F.col("no") + 1) / F.lit(float(no_total)))
    prior = F.log(F.lit((documents["yes"] + 1.0) / (documents["no"] + 1.0)))
    common = (F.col("yes") + F.col("no")) * COMMON >= F.lit((total["yes"] or 0) + (total["no"] or 0))
    return WordModel(counts.select("word", ratio.alias("ratio"), common.alias("common")), F.log(F.lit(float(no_total) / yes_total)), prior)


def word_scores(items: DataFrame, model: WordModel) -> DataFrame:
    """``ord`` and ``score`` of each item (``ord``, ``text``): the log odds that it is relevant, by the mean of its words.

    Common words, at most ``COMMON`` of them whatever the data, are looked up where they stand and leave one sum per
    item. The others are counted in each item before they meet the rest of the vocabulary, so that a word costs one
    row per item; only these rows are shuffled.
    """
    common = model.ratios.filter("common").select("word", F.col("ratio").alias("_common"))
    each = items.select("ord", _words(F.col("text")).alias("word")).join(F.broadcast(common), "word", "left")
    # A key that is no word and differs by item, so that the sums of common words spread in the join.
    rest = F.when(F.col("_common").isNotNull(), F.concat(F.lit(" "), F.coalesce(F.col("ord").cast("string"), F.lit("")))).otherwise(F.col("word"))
    counted = each.groupBy("ord", rest.alias("word")).agg(F.sum("_common").alias("_common"), F.count(F.lit(1)).alias("n"))
    looked_up = counted.join(model.ratios.filter("NOT common").select("word", "ratio"), "word", "left")
    sums = looked_up.groupBy("ord").agg(
        (F.sum(F.coalesce("_common", F.col("n") * F.coalesce("ratio", model.unseen))) / F.sum("n")).alias("mean")
    )
    return items.select("ord").join(sums, "ord", "left").select("ord", (F.coalesce("mean", F.lit(0.0)) * 10 + model.prior).alias("score"))


def word_model_scorer(model: WordModel) -> Scorer:
    """A counted classifier as a scorer over title and whole snippet; YES for positive scores."""

    def score(df: DataFrame) -> DataFrame:
        scores = word_scores(df.select("ord", F.concat_ws(" ", "title", "reasoning").alias("text")), model)
        answer = F.when(F.col("score") > 0, "YES").otherwise("NO")
        scored = df.join(scores, "ord").withColumn("is_relevant", answer)
        return scored.withColumn("reasoning", F.lit("classifier")).select(*df.columns, "is_relevant")

    return score


def score_relevance(df: DataFrame, scorer: Scorer, cap: int | None = None) -> DataFrame:
    """Articles answered YES among the first ``cap`` of the ranking (all of them without a cap).
    The cap comes first, so that a costly scorer sees no more rows than it must."""
    scored = scorer(top(df, cap)).filter(is_yes(F.col("is_relevant")))
    return scored.select(*df.columns)
