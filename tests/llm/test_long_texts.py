"""Very long texts: the work of the operators grows with the text, not with its square."""

import random
import time

from broadsheet.llm import exact_dedup, line_dedup, secrets


def test_lines(spark):
    """200,000 lines in one document, half of them on all sites; the same again twice as long."""
    seconds = {}
    for lines in (100_000, 200_000):
        text = "\n".join(f"own {i}" if i % 2 else f"shared {i % 50}" for i in range(lines))
        docs = [(i, text if i == 0 else "\n".join(f"shared {j}" for j in range(0, 50, 2)), f"site {i}") for i in range(6)]
        frame = spark.createDataFrame(docs, "doc_id LONG, text STRING, source STRING")
        start = time.time()
        found = {row["id"]: row for row in line_dedup.remove_boilerplate(frame).collect()}
        seconds[lines] = time.time() - start
        assert (found[0]["n_lines"], found[0]["n_removed"]) == (lines, lines // 2)
        assert found[0]["text"] == "\n".join(f"own {i}" for i in range(1, lines, 2))
        assert found[1]["text"] == ""
    assert seconds[200_000] < 60


def test_blocks(spark):
    """Two equal texts of ten megabytes, and one that differs in its last byte."""
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefgh é", k=9_000_000))
    frame = spark.createDataFrame([(1, text), (2, text), (3, text[:-1] + "!")], "doc_id LONG, text STRING")
    start = time.time()
    found = {row["id"]: (row["keep_id"], row["group_size"]) for row in exact_dedup.duplicate_groups(frame).collect()}
    assert found == {1: (2, 2), 2: (2, 2), 3: (3, 1)}
    assert time.time() - start < 60


def test_spans():
    """40,000 secrets and tokens in one text, and the same answer as from all pairs."""
    rng = random.Random(2)

    def text(n):
        parts = []
        for _ in range(n):
            token = "".join(rng.choices("abcdefghijXYZ0123456789", k=24))
            parts.append(rng.choice([f"password = {token}", token, "".join(rng.choices("0123456789abcdef", k=20)), f"x/{token}", "AKIA" + token.upper()]))
        return " ".join(parts)

    for n in (0, 1, 300):
        words = text(n)
        base = secrets.base_spans(words)
        every = secrets.token_spans(words, [])
        pairs = [t for t in every if not any(s < t[2] and t[0] < e for s, _, e, _ in base)]
        assert secrets.token_spans(words, base) == pairs
    words = text(40_000)
    start = time.time()
    secrets.token_spans(words, secrets.base_spans(words))
    assert time.time() - start < 10
