"""Prefix trie against a trie built turn by turn."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import prefix_trie
from broadsheet.llm.queries import QUERIES

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, no STRING, conv STRING, pos STRING, digest STRING, Block STRING"


def sequences(rows):
    """Turns of each conversation in order; ties of ``turn`` by digest."""
    found = {}
    for row in rows:
        if row["conv_id"] is not None:
            role, text = row["role"] or "", row["text"] or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            found.setdefault(row["conv_id"], []).append((row["turn"] is not None, row["turn"] or 0, mark, role, text))
    return {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in found.items()}


def rebuilt(found):
    out = {}
    for conv, turns in found.items():
        head = zlib.crc32(str(conv).encode()) % 9
        out[conv] = found.get(conv - conv % 5, [])[:head] + turns[head:]
    return out


def expected(found):
    ids, nodes, members, ends = {}, {0: (0, None, 0)}, {}, {}
    for conv, turns in found.items():
        node = 0
        members.setdefault(0, []).append(conv)
        for depth, turn in enumerate(turns, 1):
            child = ids.setdefault((node, turn), len(ids) + 1)
            nodes[child] = depth, node, len(turn[1].encode())
            members.setdefault(child, []).append(conv)
            node = child
        ends.setdefault(node, []).append(conv)
    if not found:
        return []
    children, leaves, saved = ({node: 0 for node in nodes} for _ in range(3))
    for _, parent, _ in nodes.values():
        if parent is not None:
            children[parent] += 1
    for node in sorted(nodes, key=lambda node: -nodes[node][0]):
        _, parent, size = nodes[node]
        leaves[node] += children[node] == 0
        saved[node] += (len(members[node]) - 1) * size
        if parent is not None:
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    return sorted(
        (
            min(members[node]), depth, None if parent is None else min(members[parent]), len(members[node]), children[node],
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, (depth, parent, _) in nodes.items()
    )


def nodes(df, **options):
    return sorted(tuple(row) for row in prefix_trie.prefix_nodes(df, **options).collect())


def small(monkeypatch, block, piece, part):
    for name, value in (("BLOCK", block), ("PIECE", piece), ("LIST_ROWS", part)):
        monkeypatch.setattr(prefix_trie, name, value)


def messy_rows():
    """Nulls in each column, ties, repeated rows, copies, prefixes, a hot first turn and one very long conversation."""
    rng = random.Random(7)
    rows = []

    def add(conv, turns):
        for i, (role, text) in enumerate(turns):
            rows.append((conv, i, role, text, *["clash"] * 5))

    hot = ("system", "the same for most é")
    for conv in range(60):
        kind = rng.random()
        turns = [hot] if kind < 0.7 else []
        turns += [(rng.choice(["user", None]), rng.choice(["a", "bb", "", None, "long " * 9])) for _ in range(rng.randint(0, 4))]
        add(conv, turns)
    long = [("user", f"turn {i % 3}") for i in range(150)]
    add(100, long)
    add(101, long)
    add(102, long[:-1])
    add(103, [*long[:75], ("user", "other"), *long[76:]])
    add(1 << 40, [hot, hot])
    add(-3, [hot, hot])
    rows += [(None, 0, "user", "of nobody", *[None] * 5), (7, None, "user", "null turn", *["x"] * 5), (8, 0, "user", "tie", *["x"] * 5)]
    rows += [rows[0], rows[0]]
    return rows


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.mark.parametrize("block, piece, part", [(4096, 32, 4096), (4, 2, 2), (1, 1, 1), (7, 40, 3)])
def test_messy(spark, table, monkeypatch, block, piece, part):
    small(monkeypatch, block, piece, part)
    assert nodes(table) == expected(sequences(table.collect()))


def test_spliced(spark, monkeypatch):
    """Donors that are missing or short, and conversations left without turns."""
    small(monkeypatch, 4, 3, 2)
    rng = random.Random(9)
    rows = [
        (conv, turn, "user", rng.choice("abc"), *[None] * 5)
        for conv in range(80) if conv % 10 or conv % 20 == 0
        for turn in range(rng.randint(1, 9))
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    want = rebuilt(sequences(df.collect()))
    assert any(not turns for turns in want.values())
    conv = F.col("conv")
    got = nodes(df, donor=conv - conv % 5, head=F.crc32(conv.cast("string").cast("binary")) % 9, longest_head=8)
    assert got == expected(want)


def test_without_turns(spark):
    """Only turnless conversations: a root that is a leaf."""
    df = spark.createDataFrame([(7, 0, "a", "b", *[None] * 5)], SCHEMA)
    got = nodes(df, donor=F.lit(1), head=F.lit(3), longest_head=3)
    assert got == [(7, 0, None, 1, 0, 1, 0, hashlib.sha256(b"7").hexdigest())]


def test_one_and_copies(spark, monkeypatch):
    small(monkeypatch, 2, 2, 2)
    for copies in (1, 2, 9):
        df = spark.createDataFrame([(c, t, "r", f"t{t}", *[None] * 5) for c in range(copies) for t in range(3)], SCHEMA)
        assert nodes(df) == expected(sequences(df.collect()))


def test_empty(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []


def test_sparse_table():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 8, 33):
        values = rng.integers(0, 4, size)
        table = prefix_trie.SparseTable(values)
        for low in range(size):
            for high in range(low, size):
                assert table.least(np.array([low]), np.array([high]))[0] == values[low : high + 1].min()
            for depth in range(6):
                right = low
                while right + 1 < size and values[right + 1] >= depth:
                    right += 1
                left = low
                while left > 0 and values[left] >= depth:
                    left -= 1
                place, wanted = np.array([low]), np.array([depth])
                assert table.right(place, wanted, size - 1)[0] == right
                assert table.left(place, wanted)[0] == left


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    want = expected(rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet").collect())))
    assert sorted(tuple(row) for row in QUERIES["op11_prefix_trie"](spark, sf_dir).collect()) == want
