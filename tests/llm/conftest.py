"""Messy tables and brute force that several tests share."""

import random
import re

import pytest

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Extra columns with names that operators use inside.
EXTRA = ["id", "key", "digest", "name", "fp", "_found", "component", "block", "size", "Site", "batches"]
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, " + ", ".join(f"`{c}` STRING" for c in EXTRA)


def sentence(rng, words=40, alphabet="aeinorstlu"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(words))


def messy_rows():
    """Nulls in each column, empty and blank texts, ties, repeated rows, odd characters, a long text."""
    rng = random.Random(5)
    base, other = sentence(rng, 120), sentence(rng, 80)
    long_text = sentence(rng, 30_000)
    texts = [
        base, base, base + " end", base.replace("a", "A"), other, other + "\n" + base, None, None, "", "   \n\t ", "x",
        "two words", "é ü ñ 漢字 \U0001f600 " * 30, "a" * 1000, "ab" * 700, long_text, long_text, long_text + " x", "123 456 !!",
        "line one\nline two\n\nline one\n", "    \x1f odd", base[:-1], "NUL \x00 inside " + other,
    ]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i, text, ["en", "de", None][i % 3], ["s1", "s2", None, "s0"][i % 4], i, *[f"e{i}"] * len(EXTRA)))
    rows.append(rows[0])  # a repeated row
    rows.append((0, base, "de", "s9", 1, *["other"] * len(EXTRA)))  # same id and text, other columns
    rows.append((None, base, "en", "s1", None, *[None] * len(EXTRA)))
    rows.append((None, None, None, None, None, *[None] * len(EXTRA)))
    rows.append((None, None, None, None, None, *[None] * len(EXTRA)))
    return rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_rows(spark):
    """The smallest documents table as rows."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
