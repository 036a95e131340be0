from collections import Counter, defaultdict

import numpy as np
import pytest

from broadsheet.llm import mixing
from broadsheet.llm.queries import op3_mixing
from tests.conftest import SMALL
from tests.llm.conftest import WORD, messy_rows


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Words of each source, sources in order: raise the level until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in full]
        if not free:
            break
        level = (total - sum(cap * sizes[n] for n in full)) / sum(weight[n] for n in free)
        above = {n for n in free if weight[n] * level > cap * sizes[n]}
        if not above:
            break
        full |= above
    return {n: cap * sizes[n] if n in full else weight[n] * level for n in names}


def check_report(rows, docs):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in docs:
        sizes[source] += len(WORD.findall(text or ""))
    expected = Counter((i, len(WORD.findall(t or "")), s) for i, t, s in docs)
    assert Counter((row["doc_id"], row["size"], row["source"]) for row in rows) == expected
    targets = brute_targets(sizes)
    for row in rows:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(targets[row["source"]], abs=1e-6)
        assert 0 <= row["taken"] <= 2 * row["size"]
        taken[row["source"]] += row["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 64 + 0.01 * target


def test_query(spark, sf_rows):
    rows = op3_mixing(spark, SMALL).collect()
    check_report(rows, [(row["doc_id"], row["text"], row["source"]) for row in sf_rows])
    assert Counter(map(tuple, rows)) == Counter(map(tuple, op3_mixing(spark, SMALL).collect()))


def test_messy_and_empty(spark, messy, empty):
    docs = [(row[0], row[1], row[3]) for row in messy_rows()]
    check_report(mixing.mix(messy).report().collect(), docs)
    assert mixing.mix(empty).report().count() == 0 and mixing.mix(empty).blocks(empty).count() == 0
    blank = messy.filter("length(trim(text)) = 0 OR text IS NULL")
    assert {row["taken"] for row in mixing.mix(blank).report().collect()} == {0}


def test_many_chunks_and_shards(spark, sf_rows, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 17)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = mixing.mix(docs, block=16, per_shard=50)
    check_report(made.report().collect(), [(row["doc_id"], row["text"], row["source"]) for row in sf_rows])
    shards = Counter(row["shard"] for row in made.slots.collect())
    assert len(shards) > 100 and max(shards.values()) - min(shards.values()) <= 1


def test_slots_are_permutations(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = mixing.mix(docs, per_shard=64)
    sources = {row["source_no"]: row for row in made.sources.collect()}
    slots = defaultdict(dict)
    for row in made.slots.collect():
        slots[row["source_no"]][row["slot"]] = row["block"]
    for number, own in slots.items():
        blocks, quota = sources[number]["blocks"], sources[number]["quota"]
        assert sorted(own) == list(range(quota))
        for turn in range(-(-quota // blocks)):
            used = [own[slot] for slot in range(turn * blocks, min(quota, (turn + 1) * blocks))]
            assert len(set(used)) == len(used) and set(used) <= set(range(blocks))


def test_blocks_hold_the_words(spark, messy):
    made = mixing.mix(messy, block=8, per_shard=40)
    words = Counter()
    taken = sum(row["taken"] for row in made.report().collect())
    rows = made.blocks(messy).collect()
    for row in rows:
        parts = row["text"].split(" ")
        assert 1 <= len(parts) <= 8
        words.update(parts)
    assert sum(words.values()) == taken and len(rows) == made.slots.count()
    known = {word for row in messy_rows() for word in WORD.findall(row[1] or "")}
    assert set(words) <= known


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    image = mixing.permuted(np.arange(size), size, [1, 2, 3])
    assert sorted(image) == list(range(size))


def test_split_counts_follow_the_shares():
    counts = np.array([600, 300, 100, 0])
    drawn = np.array([mixing.split_counts(counts, 500, [seed]) for seed in range(300)])
    assert (drawn.sum(axis=1) == 500).all() and (drawn <= counts).all()
    assert np.abs(drawn.mean(axis=0) - counts / 2).max() < 6
    assert (mixing.split_counts(counts, 1000, [1]) == counts).all()
