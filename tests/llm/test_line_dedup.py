import random
from collections import Counter, defaultdict

from broadsheet.llm import line_dedup
from broadsheet.llm.queries import op5_line_dedup
from tests.conftest import SMALL
from tests.llm.conftest import messy_rows


def brute(docs, least):
    sites = defaultdict(set)
    for _, text, site in docs:
        for line in (text or "").split("\n"):
            sites[line].add(site)
    out = Counter()
    for doc_id, text, _ in docs:
        if text is None:
            out[doc_id, 0, 0, None] += 1
            continue
        lines = text.split("\n")
        kept = [line for line in lines if len(sites[line]) < least or not line.strip(" \t\n\x0b\x0c\r")]
        out[doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def run(spark, docs, least, **options):
    frame = spark.createDataFrame(docs, "doc_id LONG, text STRING, source STRING")
    return Counter(map(tuple, line_dedup.remove_boilerplate(frame, min_sites=least, **options).collect()))


def test_messy(spark, messy, empty):
    docs = [(row[0], row[1], row[3]) for row in messy_rows()]
    for least in (1, 2, 3):
        assert run(spark, docs, least) == brute(docs, least)
    assert line_dedup.remove_boilerplate(messy).count() == messy.count()
    assert line_dedup.remove_boilerplate(empty).count() == 0


def test_near_the_threshold_counts_are_exact(spark):
    """Lines on 90 to 110 sites at a threshold of 100, with sketches far too coarse to tell."""
    rng = random.Random(1)
    docs = [(n * 1000 + s, f"line of {n}\nown {n} {s}", f"site {s}") for n in range(80, 121) for s in rng.sample(range(500), n)]
    docs += [(10_000_000 + s, "everywhere", f"site {s}") for s in range(500)]
    assert run(spark, docs, 100, log_k=6) == brute(docs, 100)


def test_native_plan(spark):
    plan = op5_line_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
