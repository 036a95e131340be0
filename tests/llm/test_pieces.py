"""Piece encoding and decoding against the library that defines the format."""

import glob
import hashlib
import os
import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import pieces
from broadsheet.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
with open(PATH, "rb") as _file:
    TABLES = pieces.compile_model(_file.read())
MODEL = pieces.PieceModel(TABLES)
ODD = [*" \n\t▁aeéßñ漢字😀\x00\x1f​﻿́ �", "  ", "the", "ing", "</s>", "<unk>", "<0x41>", "    ", "\r\n"]


def same(text):
    ids, bounds = MODEL.encode(text)
    found = LIBRARY.encode(text, return_type="proto").pieces
    assert ids == [piece.id for piece in found]
    assert list(zip(bounds, bounds[1:])) == [(piece.begin, piece.end) for piece in found]
    assert MODEL.decode([*ids, MODEL.end]) == LIBRARY.decode([*ids, MODEL.end])


def test_odd_texts():
    rng = random.Random(1)
    for _ in range(2000):
        same("".join(rng.choices(ODD, k=rng.randint(0, 40))))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text)


@pytest.mark.parametrize("text", ["", " ", "a" * 5000, " " * 3000, "漢" * 500, "ab" * 64 + " " + "x" * 65, "\n" * 200])
def test_long_segments(text):
    same(text)


def test_documents(sf_rows):
    for row in sf_rows:
        same(row["text"] or "")


def test_windows(sf_rows, monkeypatch):
    """Texts cut into windows give the same pieces as whole ones."""
    monkeypatch.setattr(pieces, "WINDOW", 50)
    for row in sf_rows[:60]:
        same(row["text"] or "")
    same("a▁b  c ▁ d" * 40)


def test_many_texts_at_once(sf_rows):
    texts = [row["text"] or "" for row in sf_rows] + ["", "", "x"]
    ids, starts, counts, sizes = MODEL.encode_all(texts)
    assert counts.tolist() == [len(LIBRARY.encode(text)) for text in texts]
    assert sizes.tolist() == [len(text.encode()) for text in texts]
    assert ids.tolist() == [i for text in texts for i in LIBRARY.encode(text)]
    assert len(starts) == len(ids)


def test_any_ids():
    rng = random.Random(2)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(300), 259, 28705, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        assert MODEL.decode(ids) == LIBRARY.decode(ids)
    assert MODEL.decode([200] * 5000) == LIBRARY.decode([200] * 5000)


MAPS = sorted(glob.glob(os.path.join(os.path.dirname(sentencepiece.__file__), "package_data", "*.bin")))


@pytest.mark.parametrize("path", MAPS, ids=os.path.basename)
@pytest.mark.parametrize("trim, dummy", [(False, False), (True, True), (True, False), (False, True)])
def test_character_maps(path, trim, dummy):
    """The library's own compiled maps, with all settings; alignments point at what a character came from."""
    with open(path, "rb") as file:
        model = pieces.PieceModel(TABLES | {"map": file.read(), "trim": trim, "dummy_prefix": dummy})
    name = os.path.basename(path).removesuffix(".bin")
    rule = sentencepiece.SentencePieceNormalizer(
        rule_name=name, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=trim
    )
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choices(" 　ﬁ①é́eABaÅ㌀ ​\tがは゛ͅǆ\x01", k=rng.randint(0, 14)))
        normal, starts = model.normalise(text)
        assert normal == rule.normalize(text)
        assert len(starts) == len(normal) + 1
        assert (starts[1:] >= starts[:-1]).all() and starts[-1] <= len(text.encode())
    assert model.normalise("xﬁ①")[1].tolist()[-4:] == [1, 1, 4, 7]


def test_spans_through_a_map():
    with open(MAPS[0], "rb") as file:
        model = pieces.PieceModel(TABLES | {"map": file.read()})
    text = "the ﬁne ① house"
    ids, bounds = model.encode(text)
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(bounds, bounds[1:])) == raw
    assert len(ids) + 1 == len(bounds)


def test_refused():
    with pytest.raises(ValueError):
        pieces.compile_model(b"\x12\x02\x18\x01")  # a unigram model


def messy_expected(rows):
    for row in rows:
        ids = [*LIBRARY.encode(row["text"] or ""), 2]
        yield row["doc_id"], ids, LIBRARY.decode(ids), len((row["text"] or "").encode())


def test_messy(spark, messy):
    model = pieces.load_model(spark, PATH)
    found = pieces.decode(pieces.encode(messy, model), model).collect()
    got = [(r["id"], r["ids"], r["text"], r["bounds"][-1]) for r in found]
    assert sorted(got, key=repr) == sorted(messy_expected(messy.collect()), key=repr)


def test_empty(spark, empty):
    model = pieces.load_model(spark, PATH)
    assert pieces.decode(pieces.encode(empty, model), model).collect() == []


def test_null_ids(spark):
    model = pieces.load_model(spark, PATH)
    rows = spark.createDataFrame([(None,), ([],), ([22557, 2],)], "ids ARRAY<INT>")
    assert [r["text"] for r in pieces.decode(rows, model).collect()] == [None, "", "Hello"]


def test_time_is_linear():
    """Ten megabytes of one text, and one segment of 200,000 characters."""
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoin", k=rng.randint(2, 9))) for _ in range(50_000)]
    text = " ".join(rng.choices(words, k=1_500_000))
    start = time.time()
    ids, bounds = MODEL.encode(text)
    assert bounds[-1] == len(text) and time.time() - start < 60
    start = time.time()
    MODEL.encode("".join(rng.choices("etaoin", k=200_000)))
    assert time.time() - start < 30


def test_query(spark, sf_rows):
    got = {row["doc_id"]: tuple(row) for row in QUERIES["op12_pieces"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(sf_rows)
    for doc_id, ids, text, size in messy_expected(sf_rows):
        spelled = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id] == (doc_id, len(ids), spelled, hashlib.sha256(text.encode()).hexdigest(), size)
