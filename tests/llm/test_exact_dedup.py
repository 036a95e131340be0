import hashlib
from collections import Counter, defaultdict

from broadsheet.llm import exact_dedup
from broadsheet.llm.queries import op8_exact_dedup
from tests.conftest import SMALL
from tests.llm.conftest import messy_rows

LEAST = -(1 << 62)


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: LEAST if i is None else i)
        left = 1
        for doc_id in sorted(ids, key=lambda i: LEAST if i is None else i):
            kept = doc_id == keep and left > 0
            left -= kept
            out[doc_id, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def test_query(spark, sf_rows):
    found = Counter(map(tuple, op8_exact_dedup(spark, SMALL).collect()))
    assert found == brute([(row["doc_id"], row["text"]) for row in sf_rows])


def test_messy_at_several_block_sizes(spark, messy):
    expected = brute([row[:2] for row in messy_rows()])
    for block in (1, 7, 2048):
        docs = messy if block > 1 else messy.filter("length(text) < 2000 OR text IS NULL")
        wanted = expected if block > 1 else brute([r[:2] for r in messy_rows() if r[1] is None or len(r[1]) < 2000])
        found = exact_dedup.duplicate_groups(docs, block=block).select("id", "keep_id", "group_size", "kept", "digest")
        assert Counter(map(tuple, found.collect())) == wanted


def test_names_tell_texts_apart(spark):
    """Also texts that share all blocks but their order, or their end."""
    texts = ["aabb", "bbaa", "aabbaa", "aabb", "aab", "aabba", "", "aa", "aabbaabb", "aabbaabb", "aabbaabba"]
    frame = spark.createDataFrame(list(enumerate(texts)), "rid LONG, text STRING")
    names = {row["rid"]: (row["level"], row["name"]) for row in exact_dedup.name_texts(frame, block=2).collect()}
    assert len(names) == len(texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (names[i] == names[j]) == (a == b)


def test_native_plan(spark):
    plan = op8_exact_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty(spark, empty):
    assert exact_dedup.duplicate_groups(empty).count() == 0
