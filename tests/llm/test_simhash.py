import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from broadsheet.llm import simhash
from broadsheet.llm.components import components
from broadsheet.llm.queries import op9_simhash
from tests.conftest import SMALL
from tests.llm.conftest import LOWER, WORD, messy_rows


def brute_print(text, width=4):
    words = WORD.findall((text or "").translate(LOWER))
    parts = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, ids):
    """Smallest id of each row's component; rows without an id count only as links."""
    values = sorted(set(prints))
    array = np.array(values, np.uint64)
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for v in values:
        for near in array[np.bitwise_count(array ^ np.uint64(v)) <= 4]:
            parent[root(int(near))] = root(v)
    least = {}
    for v, i in zip(prints, ids):
        r = root(v)
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [least.get(root(v)) for v in prints]


def test_query_against_brute_force(spark, sf_rows):
    prints = [brute_print(row["text"]) for row in sf_rows]
    ids = [row["doc_id"] for row in sf_rows]
    expected = {i: (f"{v:016x}", c) for i, v, c in zip(ids, prints, brute_components(prints, ids))}
    assert {row["doc_id"]: tuple(row)[1:] for row in op9_simhash(spark, SMALL).collect()} == expected


def test_messy(spark, messy):
    rows = messy_rows()
    prints = [brute_print(row[1]) for row in rows]
    ids = [row[0] for row in rows]
    expected = Counter((i, v, c) for i, v, c in zip(ids, prints, brute_components(prints, ids)))
    found = simhash.near_duplicates(messy).collect()
    assert Counter((row["doc_id"], row["fp"] % (1 << 64), row["component_id"]) for row in found) == expected
    gone = sum(row["n"] for row in simhash.not_kept(simhash.near_duplicates(messy)).collect())
    assert gone == len(rows) - len({simhash_component for simhash_component in _components(prints)})


def _components(prints):
    return brute_components(prints, prints)


def test_pigeonring_misses_nothing():
    """Every difference of up to 4 bits leaves one of the key sets equal and has a chain."""
    keys = simhash.equal_segments(4)
    assert len(keys) == 70
    rng = np.random.default_rng(1)
    for bits in range(5):
        for _ in range(3000):
            differing = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
            assert any(all(not differing >> (8 * s) & 255 for s in key) for key in keys)
            assert simhash.has_chain(np.array([differing], np.uint64), 4)[0]
    assert not simhash.has_chain(np.array([(1 << 64) - 1], np.uint64), 4)[0]


@pytest.mark.parametrize("sparse", [2, 48])
def test_crowded_buckets(spark, sparse):
    """Hundreds of fingerprints near one another, with small and with large limits for pairs."""
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {0, (1 << 64) - 1}
    for centre in centres:
        for _ in range(150):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 6)):
                value ^= 1 << bit
            prints.add(value)
    prints = sorted(prints)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in prints]
    links = simhash.links(spark.createDataFrame(signed, "fp LONG"), 4, sparse)
    for a, b in links.collect():
        assert bin((a ^ b) % (1 << 64)).count("1") <= 4
    found = {row["node"]: row["component"] for row in components(links).collect()}
    groups = Counter(brute_components(prints, prints))
    mine = Counter(found.get(v[0], v[0]) for v in signed)
    assert sorted(groups.values()) == sorted(mine.values())


def test_components_of_a_long_path(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(1000, 1001), (1001, 1000), (7, 7)], "a LONG, b LONG"))
    found = {row["node"]: row["component"] for row in components(links).collect()}
    assert all(found[i] == 0 for i in range(301)) and found[1001] == found[1000] == 1000 and len(found) == 303


def test_empty(spark, empty):
    assert simhash.near_duplicates(empty).count() == 0
