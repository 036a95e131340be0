import random
import re

from pyspark.sql import functions as F

from broadsheet.llm import decontamination
from tests.llm.conftest import LOWER, messy_rows, sentence

TOKEN = re.compile("[0-9a-z\x80-\U0010ffff]+")


def brute_shingles(text):
    words = TOKEN.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(docs, items):
    found = set()
    for d, doc in docs:
        own = brute_shingles(doc)
        for i, item in items:
            parts = brute_shingles(item)
            if len(words := TOKEN.findall((item or "").translate(LOWER))) in range(1, 5):
                # An item of so few words is one run of words, wherever it stands.
                spelled = TOKEN.findall((doc or "").translate(LOWER))
                runs = {tuple(spelled[k : k + len(words)]) for k in range(len(spelled))}
                if tuple(words) in runs:
                    found.add((d, i, 1, 1))
            elif parts and len(parts & own) * 5 >= len(parts) * 4:
                found.add((d, i, len(parts), len(parts & own)))
    return found


def run(spark, docs, items, **options):
    found = decontamination.contaminations(
        spark.createDataFrame(docs, "doc_id LONG, text STRING"), spark.createDataFrame(items, "item_id LONG, text STRING"), **options
    )
    rows = found.collect()
    assert all(abs(row["containment"] - row["shared_shingles"] / row["item_shingles"]) < 1e-12 for row in rows)
    return {tuple(row)[:4] for row in rows}, rows


def test_no_match_is_missed(spark):
    """Items of all sizes hidden whole, with words changed, cut short, in long documents, in blocks."""
    rng = random.Random(2)
    items = [(i, sentence(rng, words)) for i, words in enumerate([1, 2, 4, 5, 6, 9, 10, 14, 20, 33, 50, 80, 200, 400])]
    docs = []
    for n in range(120):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "changed"
        cut = rng.randint(0, len(words) // 4)
        docs.append((n, ", ".join([sentence(rng, rng.randint(0, 3000)), *words[cut:], sentence(rng, 20)]).upper()))
    docs += [(1000 + i, text) for i, text in items]
    expected = brute(docs, items)
    assert len(expected) > 40
    assert run(spark, docs, items)[0] == expected
    assert run(spark, docs, items, block_bytes=500)[0] == expected


def test_short_items_inside_documents(spark):
    """Items of one to four words: at the start, inside and at the end of long and short documents, and not where
    their words only stand in another order or inside longer words."""
    items = [(1, "Pax"), (2, "red fox"), (3, "a b c"), (4, "one two three four"), (5, "red fox runs far away")]
    rest = sentence(random.Random(4), 50)
    docs = [
        (1, f"pax {rest}"), (2, f"{rest} red, FOX {rest}"), (3, f"{rest} a b c"), (4, "one two three four"), (5, "the red fox"),
        (6, f"fox red {rest} paxes"), (7, f"{rest} one two three fourth"), (8, "two three four"), (9, None), (10, "red fox runs far away"),
    ]
    found = {pair[:2] for pair in run(spark, docs, items)[0]}
    assert found == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 2), (10, 2), (10, 5)}
    assert run(spark, docs, items)[0] == brute(docs, items) == run(spark, docs, items, block_bytes=10)[0]


def test_sketch_covers_every_way_to_miss():
    for size in range(1, 400):
        item = {str(i).encode() for i in range(size)}
        assert len(decontamination.sketch(item, 0.8)) >= min(size, size - decontamination.needed(size, 0.8) + 1)
        assert decontamination.needed(size, 0.8) == -(-4 * size // 5)


def test_messy(spark, messy, empty):
    rows = [(row[0], row[1]) for row in messy_rows()]
    items = [(1, rows[0][1]), (2, None), (None, "two words"), (4, ""), (4, rows[4][1]), (5, "x"), (5, "x")]
    expected = brute(rows, items)
    found, all_rows = run(spark, rows, items)
    assert found == expected
    holders = {d for d, i, *_ in expected if i == 5}  # the text "x", and the long one that ends in it
    assert len(holders) == 2
    assert sum(row["item_id"] == 5 for row in all_rows) == 2 * len(holders)  # repeated items are rows of their own
    frame = spark.createDataFrame(items, "item_id LONG, text STRING")
    clean = decontamination.decontaminate(messy, frame, block_bytes=300)
    bad = {d for d, *_ in expected}
    assert clean.columns == messy.columns
    texts = {row[1] for row in messy_rows() if not any(brute([(0, row[1])], items))}
    assert {row["text"] for row in clean.select("text").collect()} == texts and bad
    assert decontamination.contaminations(empty, frame).count() == 0
    none = frame.filter(F.lit(False))
    assert decontamination.contaminations(messy, none).count() == 0
    assert decontamination.decontaminate(messy, none).count() == messy.count()
