import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import quality
from broadsheet.llm.queries import op6_quality
from tests.conftest import SMALL

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0
    scored = quality.score(docs, labels.filter(learn)).select("id", "kept")
    rows = scored.join(labels.filter(~learn), F.col("id") == F.col("doc_id")).select("kept", "quality").collect()
    good = [row["kept"] for row in rows if row["quality"] == 1]
    bad = [row["kept"] for row in rows if row["quality"] == 0]
    assert len(good) > 80 and sum(good) / len(good) > 0.95
    assert bad and sum(bad) / len(bad) < 0.3


def test_query(spark):
    found = op6_quality(spark, SMALL).collect()
    assert len(found) == 200 and all(0 <= row["posterior"] <= 1 for row in found)


def brute_priors(told, labels, base):
    """Host and path priors from evidence, and each document's prior without itself, by plain loops."""
    views, view = {}, {}
    for row in told:
        good = 1 / (1 + math.exp(-(row["evidence"] + math.log(base / (1 - base)))))
        view[row["id"]] = labels.get(row["id"], good)
        views.setdefault((row["host"], row["path"]), []).append(view[row["id"]])
    hosts = {}
    for (host, _), own in views.items():
        hosts.setdefault(host, []).extend(own)
    every = [v for own in hosts.values() for v in own]
    world = sum(every) / len(every)

    def prior_strength(groups):
        spread = sum(len(own) * (np.mean(own) - parent) ** 2 for own, parent in groups)
        chance = sum(parent * (1 - parent) for _, parent in groups)
        scale = sum(len(own) * parent * (1 - parent) for own, parent in groups)
        inside = min(max((spread - chance) / max(scale - chance, 1e-9), 1e-3), 0.99)
        return 1 / inside - 1

    s = prior_strength([(own, world) for own in hosts.values()])
    host_prior = {host: (sum(own) + s * world) / (len(own) + s) for host, own in hosts.items()}
    t = prior_strength([(own, host_prior[host]) for (host, _), own in views.items()])
    path_prior = {key: (sum(own) + t * host_prior[key[0]]) / (len(own) + t) for key, own in views.items()}
    without = {}
    for row in told:
        own, path = hosts[row["host"]], views[row["host"], row["path"]]
        host = (sum(own) - view[row["id"]] + s * world) / (len(own) - 1 + s)
        without[row["id"]] = (sum(path) - view[row["id"]] + t * host) / (len(path) - 1 + t)
    return host_prior, path_prior, without


def test_priors_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality.score(docs, labels).collect()
    known = {row["doc_id"]: row["quality"] for row in labels.collect()}
    host_prior, path_prior, without = brute_priors(rows, known, sum(known.values()) / len(known))
    for row in rows:
        assert row["host_prior"] == pytest.approx(host_prior[row["host"]], abs=1e-9)
        assert row["path_prior"] == pytest.approx(path_prior[row["host"], row["path"]], abs=1e-9)
        prior = without[row["id"]]
        assert row["prior"] == pytest.approx(prior, abs=1e-9)
        assert row["posterior"] == pytest.approx(1 / (1 + math.exp(-row["evidence"]) * (1 - prior) / prior), abs=1e-9)


def test_fit_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("label_id"), F.lit(1).alias("label"))
    assert 400 < quality.bounded(labels, 500).count() < 600
    assert quality.bounded(labels, 10_000).count() == 5000


def test_sparse_sites_shrink(spark):
    """Sites of one document stay near the whole, sites of many go their own way."""
    rows = [(i, "fine words here", f"big{i % 2}", "p") for i in range(400)] + [(1000, "fine words here", "small", "p")]
    labels = [(i, 1 if i % 2 else i % 4 // 2) for i in range(400)] + [(1000, 0)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, lang STRING")
    scored = quality.score(docs, spark.createDataFrame(labels, "doc_id LONG, quality INT")).select("host", "host_prior").distinct()
    prior = {row["host"]: row["host_prior"] for row in scored.collect()}
    assert prior["big0"] < 0.55 and prior["big1"] > 0.95 and prior["small"] > 0.2


def test_messy_and_empty(spark, messy, empty):
    labels = spark.createDataFrame([(0, 1), (0, 0), (4, 0), (5, None), (None, 1), (6, 7), (10, 1)], "doc_id LONG, quality INT")
    found = quality.score(messy, labels).collect()
    assert len(found) == messy.count() and all(0 <= row["posterior"] <= 1 for row in found)
    assert all(row["evidence"] == 0 for row in quality.score(messy.filter("text IS NULL OR trim(text) = ''"), labels).collect())
    assert quality.score(empty, labels).count() == 0
    unlabelled = quality.score(messy, labels.filter("doc_id < 0")).collect()
    assert all(abs(row["posterior"] - 0.5) < 1e-9 for row in unlabelled)
