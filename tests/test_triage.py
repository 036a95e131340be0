"""Mirror triage against a brute-force walk."""

import random
import re

import pytest

from broadsheet.operators.triage import triage

SCHEMA = "ord BIGINT, title STRING, domain STRING, tier INT, seendate STRING"


def brute_force(rows):
    def authority(row):
        ord_, _, domain, tier, seendate = row
        return (0 if re.search(r"(^|\.)(gov|mil|gov\.cn)$", domain) else 1, tier, -int(seendate), ord_)

    kept, sets = [], []
    for row in sorted(rows, key=authority):
        words = set(re.findall("[a-z0-9]+", row[1].lower()))
        if words and any(18 * len(words & other) >= 8 * (len(words) + len(other)) for other in sets):
            continue
        kept.append(row[0])
        if words:
            sets.append(words)
    return sorted(kept)


def make(seed, n, vocabulary, sizes, edits):
    """Titles in families: a base and variants with some words changed."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    bases = [rng.sample(words, rng.choice(sizes)) for _ in range(max(1, n // 6))]
    rows = []
    for i in range(n):
        # Half of all titles belong to one family.
        title = list(bases[0] if rng.random() < 0.5 else rng.choice(bases))
        for _ in range(rng.randint(0, edits)):
            change = rng.random()
            if change < 0.4 and len(title) > 1:
                title.pop(rng.randrange(len(title)))
            elif change < 0.7:
                title.append(rng.choice(words))
            else:
                title[rng.randrange(len(title))] = rng.choice(words)
        domain = rng.choice(["state.gov", "reuters.com", "af.mil", "mfa.gov.cn", "x.com"])
        rows.append((i, " ".join(title), domain, rng.randint(1, 3), f"202401{rng.randint(1, 28):02d}"))
    return rows


CASES = {
    "short": make(1, 150, 30, [1, 2, 3, 4, 5, 6], 2),
    "usual": make(2, 200, 80, [7, 9, 12, 15], 4),
    "around_forty": make(3, 80, 120, [33, 38, 40, 41, 44, 48], 12),
    "around_two_hundred": make(5, 40, 600, [158, 165, 199, 201, 204, 240], 40),
    "few_words": make(4, 150, 9, [4, 5, 6], 2),
    "wordless": [(i, t, "x.com", 1, "20240101") for i, t in enumerate(["中美", "中美", "!!", "a b", "B a"])],
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("pivots", [32, 2])
def test_like_brute_force(spark, name, pivots):
    rows = CASES[name]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(row.ord for row in triage(df, pivots=pivots).collect()) == brute_force(rows)


def test_rounds_do_not_grow_with_a_shared_word(spark, monkeypatch):
    """Long titles that share one word and nothing else are no candidates of one another."""
    from broadsheet.storage import Workspace

    def tables(n):
        written = []
        write = Workspace.write
        monkeypatch.setattr(Workspace, "write", lambda self, df: written.append(1) or write(self, df))
        rows = [(i, " ".join(["shared", *(f"w{i}x{j}" for j in range(44))]), "x.com", 1, "20240101") for i in range(n)]
        assert triage(spark.createDataFrame(rows, SCHEMA)).count() == n
        monkeypatch.undo()
        return len(written)

    assert tables(40) == tables(160) == tables(640)


def test_cap_looks_at_the_best_only(spark):
    rows = [(i, f"title number{i} of many", "x.com", 1, "20240101") for i in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(row.ord for row in triage(df, cap=4).collect()) == [0, 1, 2, 3]


def test_empty(spark):
    assert triage(spark.createDataFrame([], SCHEMA)).count() == 0


def test_reviewer_in_place_of_the_rules(spark):
    rows = [(i, f"title number{i}", "x.com", i % 2, "20240101") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    seen = []

    def reviewer(numbered):
        seen.append([r.ord for r in numbered.orderBy("pos").collect()])
        return spark.createDataFrame([(0,), (0,), (3,), (99,)], "index INT")

    assert sorted(r.ord for r in triage(df, reviewer=reviewer).collect()) == [0, 1]
    assert seen == [[0, 2, 4, 1, 3, 5]]
