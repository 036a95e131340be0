import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from broadsheet.llm import suffix_dedup
from broadsheet.llm.queries import op2_suffix_dedup
from tests.conftest import SMALL
from tests.llm.conftest import messy_rows, sentence


def brute(texts, length=200):
    """n_bytes, n_removed, n_spans, kept_sha256 of each text."""
    data = [(text or "").encode() for text in texts]
    counts = Counter(hash(b[s : s + length]) for b in data for s in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if counts[hash(b[s : s + length])] > 1:
                covered[s : s + length] = True
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        runs = int((np.diff(np.r_[0, covered.astype(int), 0]) == 1).sum())
        out.append((len(b), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, ids, texts, **options):
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id LONG, text STRING")
    found = suffix_dedup.remove_repeats(docs, **options).drop("spans").collect()
    assert Counter(map(tuple, found)) == Counter((i, *row) for i, row in zip(ids, brute(texts)))


def test_query_against_brute_force(spark, sf_rows):
    found = {row["doc_id"]: tuple(row)[1:] for row in op2_suffix_dedup(spark, SMALL).collect()}
    expected = dict(zip([row["doc_id"] for row in sf_rows], brute([row["text"] for row in sf_rows])))
    assert found == expected


def test_messy(spark):
    rows = messy_rows()
    compare(spark, [row[0] for row in rows], [row[1] for row in rows])


@pytest.mark.parametrize("seed", range(3))
def test_passages_at_their_edges(spark, seed):
    """Passages around the length, at text borders, inside other text, periodic, overlapping."""
    rng = random.Random(seed)
    passages = [sentence(rng, 200)[:n] for n in (199, 200, 201, 215, 400)] + ["ab" * 150, "z" * 260]
    texts = []
    for _ in range(40):
        parts = [rng.choice([sentence(rng, rng.randint(1, 60)), rng.choice(passages), rng.choice(passages)[rng.randint(0, 30) :]]) for _ in range(rng.randint(1, 5))]
        texts.append(rng.choice(["", " "]).join(parts))
    # A filter of few bits lets everything through; the result must not change.
    compare(spark, list(range(40)), texts, filter_bits=1 << (6 if seed else 20))


def test_long_text_across_chunks(spark, monkeypatch):
    rng = random.Random(9)
    body = sentence(rng, 12_000)
    compare(spark, [0, 1], [body + body[100:700], "x" + body[30_000:50_000] + "y"])
    assert len(body) > suffix_dedup.CHUNK


def test_spans_give_the_rest(spark):
    rng = random.Random(3)
    common = sentence(rng, 60)
    docs = spark.createDataFrame([(1, "first " + common), (2, common + " last")], "doc_id LONG, text STRING")
    for row in suffix_dedup.remove_repeats(docs).collect():
        assert sum(s["end"] - s["start"] for s in row["spans"]) == row["n_removed"] > 200


def test_empty(spark, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
