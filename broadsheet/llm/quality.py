"""Document quality by hierarchical empirical Bayes.

A naive Bayes classifier over hashed words and a few traits of form, fitted by counting labelled
documents, gives each document's evidence as a log likelihood ratio. Hosts and paths add what is
known of their surroundings: the mean quality of a path is shrunk toward that of its host, and a
host's toward the whole corpus, the more so the fewer documents it has. The strength of each
prior follows from the spread of the groups (method of moments), so all of it comes from grouped
aggregations over all documents. A document's posterior adds its evidence to the prior that its
host and path make without it (its own view, or label, taken out of both sums), so that nothing is
counted twice where a path has few documents.

Labels of null or other values than 0 and 1 are not learned from. Null or empty text has no
evidence, and its posterior is what the others of its path make of it. Null hosts and paths are groups of their own. Without
labels of both kinds everything is as good as the prior, one half.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.storage import Workspace

BINS = 1 << 14
# Evidence of one document is a mean over its words times this number at most: words of a text
# are far from independent, and a long text is not surer than its style.
WEIGHT = 12.0
SMOOTHING = 1.0
# About so many labelled documents are fitted at most, chosen by the hash of their ids. Their ids and
# labels are broadcast, so that no text moves to meet its label.
FIT_ROWS = 20_000


def traits(text: str) -> list[str]:
    """Traits of form, each as one of a few levels."""
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    letters = sum(map(str.isalpha, text))
    caps = sum(map(str.isupper, text))
    marks = sum(not c.isalnum() and not c.isspace() for c in text)

    def level(share: float) -> int:
        return min(10, int(share * 10))

    return [
        f"distinct {level(len(counts) / n)}",
        f"commonest {level(max(counts.values(), default=0) / n)}",
        f"repeats {level(sum(a == b for a, b in zip(words, words[1:])) / n)}",
        f"capitals {level(caps / max(1, letters))}",
        f"letters {level(letters / max(1, len(text)))}",
        f"marks {level(2 * marks / n)}",
        f"words {min(20, int(2 * math.log2(n + 1)))}",
        f"mean length {min(20, int(2 * letters / n))}",
    ]


N_TRAITS = 8


def bins_of(text: str | None) -> tuple[Counter, list[int]]:
    """Hashed words with their numbers, and hashed traits."""
    if not text or text.isspace():
        return Counter(), []
    hashed = {word: zlib.crc32(word.encode("utf-8", "surrogatepass")) % BINS for word in set(text.split())}
    words: Counter = Counter()
    for word, times in Counter(text.lower().split()).items():
        words[hashed.get(word, zlib.crc32(word.encode("utf-8", "surrogatepass")) % BINS)] += times
    return words, [BINS + zlib.crc32(f"{i} {trait}".encode()) % BINS for i, trait in enumerate(traits(text))]


@dataclass
class Evidence:
    """Log likelihood ratios of bins, words first, then traits."""

    ratios: np.ndarray

    def of(self, text: str | None) -> float:
        words, forms = bins_of(text)
        if not words:
            return 0.0
        times = np.fromiter(words.values(), float, len(words))
        by_word = float(times @ self.ratios[list(words)]) / times.sum()
        by_form = float(self.ratios[forms].sum())
        return WEIGHT * by_word / 4 + by_form


def _count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sums: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, label in zip(batch["text"], batch["label"]):
            words, forms = bins_of(text)
            sums[int(label)].update(words)
            sums[int(label)].update(forms)
        rows = [(label, bin_, times) for label, counts in sums.items() for bin_, times in counts.items()]
        if rows:
            yield pd.DataFrame(rows, columns=["label", "bin", "times"]).astype("int64")


def bounded(labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of ``labels`` (``label_id``) at most, the same ones each time."""
    scale = 1 << 20
    share = min(scale, scale * rows // max(1, labels.count()))
    return labels.filter(F.pmod(F.xxhash64("label_id"), F.lit(scale)) < share)


def fit(labelled: DataFrame) -> Evidence:
    """Ratios from all rows of ``labelled`` (``text``, ``label`` 0 or 1); the model has a fixed number of bins."""
    counts = labelled.mapInPandas(_count, "label BIGINT, bin BIGINT, times BIGINT")
    rows = counts.groupBy("label", "bin").agg(F.sum("times").alias("times")).toPandas()
    table = np.zeros((2, 2 * BINS))
    table[rows["label"], rows["bin"]] = rows["times"]
    ratios = np.zeros(2 * BINS)
    if table.sum(axis=1).all():
        for part in (slice(0, BINS), slice(BINS, None)):
            own = table[:, part]
            total = own.sum(axis=1)
            if part.start:
                # A trait's levels are told against the documents, of which each has one.
                logs = np.log((own + SMOOTHING) / (total / N_TRAITS + 10 * SMOOTHING)[:, None])
            else:
                logs = np.log((own + SMOOTHING) / (total + SMOOTHING * BINS)[:, None])
            ratios[part] = np.where(own.sum(axis=0) > 0, logs[1] - logs[0], 0.0)
    return Evidence(ratios)


def strength(groups: DataFrame, mean: Column, parent: Column, size: Column) -> float:
    """How many documents a prior weighs, by the method of moments: the spread of group means about their
    parents beyond what their sizes explain. One aggregation."""
    row = groups.agg(
        F.sum(size * (mean - parent) ** 2).alias("spread"),
        F.sum(parent * (1 - parent)).alias("chance"),
        F.sum(size * parent * (1 - parent)).alias("scale"),
    ).first()
    if not row["scale"] or not row["spread"]:
        return 1.0
    # spread = chance * (1 - r) + scale * r, with r the correlation inside a group.
    inside = (row["spread"] - row["chance"]) / max(row["scale"] - row["chance"], 1e-9)
    inside = min(max(inside, 1e-3), 0.99)
    return 1.0 / inside - 1.0


def logit(p: Column) -> Column:
    clipped = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(clipped / (1 - clipped))


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    label_col: str = "quality",
    keep: float = 0.5,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of docs: the id as ``id``, ``host``, ``path``, ``evidence``, ``host_prior``, ``path_prior``, ``prior`` (the
    path's without this document), ``posterior`` (0 to 1) and ``kept`` (posterior at least ``keep``). The classifier is fitted on ``fit_rows`` labelled documents
    or so; everything else covers all documents and labels."""
    work = Workspace(docs.sparkSession, "quality")
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    # One label for each id: the lowest, should there be several.
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter("label IN (0, 1)").groupBy("label_id").agg(F.min("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    known = work.write(known)
    chosen = F.broadcast(bounded(known, fit_rows))
    labelled = rows.select("id", "text").join(chosen, F.col("id") == F.col("label_id"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(labelled.select("text", "label")).ratios)

    @F.pandas_udf("double")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Evidence(shared.value)
        for texts in batches:
            yield texts.map(model.of).astype(float)

    base = known.agg(F.avg("label").alias("m")).first()["m"]
    base = 0.5 if base is None else min(max(base, 0.01), 0.99)
    good = 1 / (1 + F.exp(-(F.col("evidence") + math.log(base / (1 - base)))))
    # Labels, where known, stand for the classifier's view of a document.
    told = rows.select("id", "host", "path", evidence("text").alias("evidence"))
    viewed = told.join(known, F.col("id") == F.col("label_id"), "left").select(
        "id", "host", "path", "evidence", F.coalesce(F.col("label").cast("double"), good).alias("good")
    )
    viewed = work.write(viewed)
    paths = work.write(viewed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")).first()
    world = (total["good"] / total["n"]) if total["n"] else base
    by_host = strength(hosts, F.col("host_good") / F.col("host_n"), F.lit(world), F.col("host_n"))
    hosts = hosts.withColumn("host_prior", (F.col("host_good") + by_host * world) / (F.col("host_n") + by_host))
    both = work.write(
        paths.withColumnRenamed("host", "h").join(hosts, F.col("h").eqNullSafe(F.col("host"))).drop("h")
    )
    by_path = strength(both, F.col("good") / F.col("n"), F.col("host_prior"), F.col("n"))
    priors = both.select(
        F.col("host").alias("h"), F.col("path").alias("p"), "host_n", "host_good", "host_prior", "n", F.col("good").alias("path_good"),
        ((F.col("good") + by_path * F.col("host_prior")) / (F.col("n") + by_path)).alias("path_prior"),
    )
    joined = viewed.join(priors, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
    host_rest = (F.col("host_good") - F.col("good") + by_host * world) / (F.col("host_n") - 1 + by_host)
    rest = (F.col("path_good") - F.col("good") + by_path * host_rest) / (F.col("n") - 1 + by_path)
    posterior = 1 / (1 + F.exp(-(F.col("evidence") + logit(F.col("prior")))))
    return joined.withColumn("prior", rest).withColumn("posterior", posterior).select(
        "id", "host", "path", "evidence", "host_prior", "path_prior", "prior", "posterior", (F.col("posterior") >= keep).alias("kept")
    )
