import zlib

import pytest

from broadsheet.llm import language_id
from broadsheet.llm.queries import op1_language_id
from tests.conftest import SMALL


def test_held_out_accuracy(spark, sf_rows):
    found = {row["doc_id"]: row for row in op1_language_id(spark, SMALL).collect()}
    assert len(found) == len(sf_rows)
    for row in sf_rows:
        assert found[row["doc_id"]]["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
    tested = [row for row in sf_rows if found[row["doc_id"]]["held_out"] and row["lang"]]
    right = sum(found[row["doc_id"]]["lang_pred"] == row["lang"] for row in tested)
    assert right / len(tested) > 0.95
    assert all(0 <= row["score"] <= 1 for row in found.values())


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the house is here", "en"), ("that house", "en"), ("das haus ist hier", "de"), ("ein haus", "de"), (None, "de"), ("x", None)]
    return language_id.learn(spark.createDataFrame(rows, "text STRING, lang STRING"))


def test_words_before_grams(model):
    assert model.languages == ["de", "en"]
    assert model.predict("haus")[0] == "de" and model.predict("House!")[0] == "en"
    # Unseen words: the longest known grams decide, single letters at last.
    assert model.predict("hausen")[0] == "de" and model.predict("houses")[0] == "en"
    five = [g for g in language_id.grams_of("hausen", 5) if g in model.grams]
    assert five and model.rows("hausen") == [model.grams[g] for g in five]
    assert model.rows("haus") == [model.words["haus"]]


def test_counts_are_brute_force_counts(model):
    de = {"das": 1, "haus": 2, "ist": 1, "hier": 1, "ein": 1}
    en = {"the": 1, "house": 2, "is": 1, "here": 1, "that": 1}
    import math

    words = sorted({*de, *en})
    assert sorted(model.words) == words
    for word in words:
        for i, counts in enumerate((de, en)):
            expected = math.log((counts.get(word, 0) + 0.5) / (sum(counts.values()) + 0.5 * len(words)))
            assert abs(model.logs[model.words[word]][i] - expected) < 1e-12


def test_undetermined(model):
    for text in (None, "", " \n", "123 !?"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("漢字")[0] == "de"  # no evidence: a tie goes to the first


def test_messy_and_empty(spark, messy, empty):
    model = language_id.learn(messy)
    found = language_id.identify(messy, model)
    assert found.columns == [*messy.columns, "lang_pred", "score"] and found.count() == messy.count()
    kept = language_id.keep_identified(messy, model)
    assert kept.columns == messy.columns
    nothing = language_id.learn(empty)
    assert nothing.languages == [] and nothing.predict("word") == ("und", 0.0)
    assert language_id.identify(empty, nothing).count() == 0 and language_id.keep_identified(messy, nothing).count() == 0


def test_sample_is_bounded(spark):
    rows = spark.range(4000).selectExpr("concat('text number ', id) AS text", "'en' AS lang")
    sample, languages = language_id.sample_by_language(rows, 500)
    assert languages == ["en"] and 350 < sample.count() < 650


def test_copies_do_not_thin_the_sample(spark):
    """A language that is mostly copies of one text, and one that is nothing else, are taken whole."""
    rows = spark.range(30_000).selectExpr("if(id < 500, concat('text number ', id), 'the same text') AS text", "'en' AS lang")
    copies = spark.range(20_000).selectExpr("'ein Text' AS text", "'de' AS lang")
    sample, languages = language_id.sample_by_language(rows.union(copies), 600)
    found = [tuple(row) for row in sample.select("lang", "text").collect()]
    assert languages == ["de", "en"]
    assert sorted(found) == sorted([("de", "ein Text"), ("en", "the same text"), *(("en", f"text number {i}") for i in range(500))])


@pytest.mark.parametrize("languages", [1, 2, 3, 5])
def test_clean_documents_stay_however_many_languages(spark, languages):
    """A script that no language has, and a short text that all of them share."""
    names = ["de", "en", "fr", "nl", "sv"][:languages]
    rows = [(f"in {name} {name}", name) for name in names]
    model = language_id.learn(spark.createDataFrame(rows, "text STRING, lang STRING"))
    assert model.languages == names
    texts = ["漢字 漢字", "in", "In in", "de", "123", "", None]
    docs = spark.createDataFrame([(text,) for text in texts], "text STRING")
    assert [row["text"] for row in language_id.keep_identified(docs, model).collect()] == texts[:4]


def test_languages_asked_for(spark):
    rows = [("the house is here", "en"), ("das haus ist hier", "de"), ("la maison est ici", "fr")]
    model = language_id.learn(spark.createDataFrame(rows, "text STRING, lang STRING"))
    texts = ["this house", "ein haus", "la maison", "12 !", None]
    docs = spark.createDataFrame([(text,) for text in texts], "text STRING")
    kept = lambda languages: [row["text"] for row in language_id.keep_identified(docs, model, languages=languages).collect()]
    assert kept(None) == texts[:3]
    assert kept(["de", "fr"]) == texts[1:3] and kept({"en"}) == texts[:1] and kept([]) == []


def test_a_small_language_keeps_its_words(spark):
    """A large language has more different words, each more frequent, than the small one."""
    large = [(" ".join(f"{a}{b}{c}" for c in "aeiou") * 5, "la") for a in "bcdfg" for b in "aeiou"]
    rows = [*large, ("zwölf kleine wörter", "sm")]
    table = spark.createDataFrame(rows, "text STRING, lang STRING")
    model = language_id.learn(table, vocabulary=5, grams=40)
    assert {"zwölf", "kleine", "wörter"} <= set(model.words) and len(model.words) == 5 + 3
    assert model.cut > 0 and model.predict("kleine")[0] == "sm"
    whole = language_id.learn(table, vocabulary=None, grams=None)
    assert whole.cut == 0 and set(model.words) < set(whole.words) and set(model.grams) < set(whole.grams)


def brute_force_prediction(training, text):
    """Language and score by the method as the docstring has it, from plain counts of all pieces."""
    from collections import Counter
    from math import exp, log

    languages = sorted({lang for _, lang in training})
    cut = lambda word, n: [word] if n == 0 else [w[i : i + n] for w in [word if n == 1 else f"_{word}_"] for i in range(len(w) - n + 1)]
    counts = {(lang, n): Counter() for lang in languages for n in range(6)}
    for words, lang in training:
        for word in language_id.words_of(words):
            for n in range(6):
                counts[lang, n].update(cut(word, n))
    known = {n: set().union(*(counts[lang, n] for lang in languages)) for n in range(6)}
    sums = dict.fromkeys(languages, 0.0)
    for word in language_id.words_of(text):
        for n in (0, 5, 4, 3, 2, 1):
            own = [piece for piece in cut(word, n) if piece in known[n]]
            if own:
                break
        for lang in languages:
            total = sum(counts[lang, n].values()) + 0.5 * len(known[n])
            sums[lang] += sum(log((counts[lang, n][piece] + 0.5) / total) for piece in own) / max(len(own), 1)
    best = max(languages, key=lambda lang: (sums[lang], [-ord(c) for c in lang]))
    return best, 1 / sum(exp(value - sums[best]) for value in sums.values())


def test_predictions_are_brute_force(spark, sf_rows):
    training = sorted({(row["text"][:400], row["lang"]) for row in sf_rows[::3] if row["text"] and row["lang"]})
    model = language_id.learn(spark.createDataFrame(training, "text STRING, lang STRING"))
    assert model.cut == 0
    for row in sf_rows[1::7]:
        # Few words, so that scores are not all 1, some of them unseen.
        text = " ".join(language_id.words_of(row["text"])[3:6]) if row["text"] else ""
        if text:
            lang, score = brute_force_prediction(training, text)
            found = model.predict(text)
            assert found[0] == lang and abs(found[1] - score) < 1e-9


def test_a_very_long_word(spark):
    rows = [("x" * 300_000 + " one", "en"), ("zwei", "de"), ("!", "fr")]
    model = language_id.learn(spark.createDataFrame(rows, "text STRING, lang STRING"))
    assert model.languages == ["de", "en", "fr"] and "x" * 300_000 in model.words
    assert model.predict("x" * 300_000)[0] == "en" and model.predict("zwei")[0] == "de"
    nothing = language_id.learn(spark.createDataFrame([("!", "fr")], "text STRING, lang STRING"))
    assert nothing.words == {} and nothing.predict("zwei") == ("fr", 1.0)


def test_the_driver_holds_columns_not_rows(spark):
    """Learning many pieces takes little more of the driver's Python than their numbers; look-ups are made in tasks."""
    import pickle
    import tracemalloc

    rows = spark.range(30_000).selectExpr("concat(translate(hex(id * 7919), '0123456789', 'ghijklmnop'), 'x') AS text", "'en' AS lang")
    model = language_id.learn(rows, per_language=30_000)
    tracemalloc.start()
    try:
        again = language_id.learn(rows, per_language=30_000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(again.logs) > 60_000 and peak < 150 * len(again.logs)
    assert "words" not in vars(again) and len(pickle.dumps(language_id.share(rows, again).value)) < 30 * len(again.logs)
    assert list(model.words) == list(again.words) and list(model.grams) == list(again.grams)
