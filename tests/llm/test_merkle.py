"""Merkle manifest against brute force."""

import hashlib
import random
import zlib

import pytest

from broadsheet.llm import merkle
from broadsheet.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def leaf_of(row):
    out = b""
    for name in FIELDS:
        value = row[name]
        raw = b"" if value is None else str(value).encode()
        out += b"-" if value is None else str(len(raw)).encode() + b":" + raw
    return sha(out)


def tree(nodes):
    """The root and the siblings of each leaf, level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(places):
            run = nodes[place // 3 * 3 : place // 3 * 3 + 3]
            paths[i].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
            places[i] = place // 3
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows):
    """Rows of leaf, subroot, root and path, sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row["source"], []).append(row)
    order = sorted(groups, key=lambda source: (source is not None, (source or "").encode()))
    found = []
    for source in order:
        group = sorted(groups[source], key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row)))
        found.append((group, *tree([leaf_of(row) for row in group])))
    root, upper = tree([subroot for _, subroot, _ in found]) if found else (None, [])
    out = []
    for (group, subroot, paths), rest in zip(found, upper):
        out += [(row, leaf_of(row), subroot, root, path + rest) for row, path in zip(group, paths)]
    return out


def key(row):
    return tuple(str(x) for x in row)


def compare(spark, df, rows):
    got = merkle.manifest(df, FIELDS, "source", "doc_id").collect()
    want = [(row["doc_id"], leaf, tuple(path), subroot, root) for row, leaf, subroot, root, path in expected(rows)]
    plain = [(r["key"], r["leaf"], tuple(tuple(s) for s in r["path"]), r["subroot"], r["root"]) for r in got]
    assert sorted(plain, key=key) == sorted(want, key=key)


def test_messy(spark, messy):
    compare(spark, messy, [row.asDict() for row in messy.collect()])


def test_empty(spark, empty):
    assert merkle.manifest(empty, FIELDS, "source", "doc_id").collect() == []


@pytest.mark.parametrize("count", [1, 2, 3, 4, 728, 729, 730, 2187, 2200])
def test_group_sizes(spark, count):
    """Around the sizes of runs and blocks; one group holds almost all rows."""
    rows = [{"doc_id": i, "source": "hot", "lang": "en", "n_chars": i, "text": f"text {i}"} for i in range(count)]
    rows += [{"doc_id": i, "source": f"s{i % 5}", "lang": None, "n_chars": i, "text": None} for i in range(7)]
    random.Random(3).shuffle(rows)
    compare(spark, spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING"), rows)


def test_many_groups(spark):
    rows = [{"doc_id": i, "source": f"s{i:04d}", "lang": "en", "n_chars": 1, "text": "x"} for i in range(800)]
    compare(spark, spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING"), rows)


def test_query(spark, sf_rows):
    got = {row["doc_id"]: row for row in QUERIES["op13_merkle"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(sf_rows)
    verified = 0
    for row, leaf, subroot, root, path in expected([row.asDict() for row in sf_rows]):
        node = leaf
        if zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
            node = leaf_of(row | {"text": None if row["text"] is None else row["text"].replace("\n", "")})
        for left, right in path:
            node = sha(left + node + right)
        proof = sha("".join(left + right for left, right in path))
        assert tuple(got[row["doc_id"]])[1:] == (leaf, subroot, root, proof, node, node == root)
        verified += node == root
    assert 0 < verified < len(sf_rows)
