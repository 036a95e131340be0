import inspect
from collections import Counter

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.conftest import WORD, messy_rows
from tests.llm.test_decontamination import brute as brute_contaminations
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_components, brute_print


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "mixing"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def brute_exact(rows):
    best = {}
    for row in rows:
        text = row[1] or ""
        if text not in best or (row[0] is not None and (best[text][0] is None or row[0] > best[text][0])):
            best[text] = row
    return Counter(row[:2] for row in best.values())


def brute_near(rows):
    prints = [brute_print(row[1]) for row in rows]
    groups = brute_components(prints, prints)
    best = {}
    for row, group in zip(rows, groups):
        order = (row[0] is None, row[0] or 0)
        if group not in best or order < best[group][0]:
            best[group] = (order, row)
    return {row[0] for _, row in best.values()}


def test_run_against_brute_force(spark, sf_rows):
    """All stages by hand; the language stage keeps every document with letters here."""
    rows = [(row["doc_id"], row["text"], row["source"]) for row in sf_rows if any(map(str.isalpha, row["text"] or ""))]
    kept = brute_exact(rows)
    rows = [row for row in rows if row[:2] in kept]
    near = brute_near(rows)
    rows = [row for row in rows if row[0] in near]
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SMALL}/benchmark.parquet").to_pylist()]
    bad = {d for d, *_ in brute_contaminations([row[:2] for row in rows], items)}
    rows = [row for row in rows if row[0] not in bad]
    assert bad and len(rows) > 100
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text))
    targets = brute_targets(dict(sizes))
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert {(row["doc_id"], row["size"], row["source"]) for row in found} == {(d, len(WORD.findall(t)), s) for d, t, s in rows}
    assert len(found) == len(rows)
    assert all(row["target"] == pytest.approx(targets[row["source"]], abs=1e-6) for row in found)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_whole_rows(spark, messy, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = Counter(map(tuple, messy_rows()))
    kept = stage(spark, messy, SMALL)
    assert kept.columns == messy.columns
    assert not Counter(map(tuple, kept.collect())) - rows
    assert stage(spark, empty, SMALL).count() == 0


def test_copies_leave_one_row(spark, messy):
    stages = dict(corpus_pipeline.STAGES)
    kept = Counter((row["doc_id"], row["text"] or "") for row in stages["exact_dedup"](spark, messy, SMALL).collect())
    assert kept == Counter({(d, t or ""): n for (d, t), n in brute_exact([row[:2] for row in messy_rows()]).items()})
    near = stages["simhash_near_dedup"](spark, messy, SMALL).collect()
    prints = [brute_print(row[1]) for row in messy_rows()]
    assert len(near) == len(set(brute_components(prints, prints)))


def test_last_stage_on_empty(spark, empty):
    assert corpus_pipeline.mix_sources(spark, empty, SMALL).count() == 0


def test_languages_decide(spark, monkeypatch):
    """Asked for some languages, the first stage drops the documents of the others and nothing else."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    predicted = corpus_pipeline.language_id
    model = predicted.learn(docs.filter(~predicted.held_out(docs["doc_id"])))
    monkeypatch.setattr(predicted, "learn", lambda training: model)
    found = {row["doc_id"]: row["lang_pred"] for row in predicted.identify(docs, model).collect()}
    assert {"de", "en"} < set(found.values())
    for languages in (None, frozenset({"de", "en"}), frozenset({"fr"})):
        monkeypatch.setattr(corpus_pipeline, "LANGUAGES", languages)
        kept = corpus_pipeline.identify_language(spark, docs, SMALL)
        assert kept.columns == docs.columns
        wanted = set(found.values()) - {"und"} if languages is None else languages
        assert {row["doc_id"] for row in kept.collect()} == {doc for doc, lang in found.items() if lang in wanted}
