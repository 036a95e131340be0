import gzip
import hashlib
from collections import Counter
from pathlib import Path

from broadsheet.llm import warc
from broadsheet.llm.queries import op10_warc
from tests.conftest import SMALL

SCHEMA = "page_id LONG, url STRING, html STRING, payload STRING, digest STRING, number STRING"


def rows():
    same, marker = "same page " * 20, "about WARC/1.1\r\nWARC-Type: response\r\n"
    pages = [
        (5, "http://a/1", same), (3, "http://a/2", same), (9, "http://a/1", same), (1, "http://a/3", "short"), (2, "http://a/3", "short"),
        (4, None, None), (6, "http://b/\r\nX: y", ""), (7, "http://c/WARC/1.1", marker * 30), (8, "http://c", "ends with WARC/1.1"),
        (10, "http://d", "WARC/1.1\r\n"), (11, "http://e", "é漢\U0001f600 " * 40 + "WARC/1.1\r\n" + "ü" * 9), (12, "http://f", "\r\n\r\n" * 40),
        (13, "http://g", "0\r\n\r\nWARC/1.1\r\n\r\n"), (14, "u", "\x00\x01 bytes " * 20), (15, "u", "x" * 99), (16, "u", "x" * 99),
        (17, "u", "y" * 100), (18, "v", "y" * 100), (19, "long", "<p>long</p>" * 200_000), (None, "n", "z" * 120), (None, "n", "z" * 120),
    ]
    return [(*page, "p", "d", "n") for page in pages]


def brute(pages):
    best, out = {}, []
    for page_id, _, html, *_ in pages:
        if page_id is not None:
            best[html] = min(page_id, best.get(html, page_id))
    for page_id, _, html, *_ in pages:
        data = (html or "").encode()
        first = len(data) < 100 or best.get(html) == page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if first else "revisit", None if first else best[html]))
    return Counter(out)


def round_trip(spark, pages, path):
    warc.write_archives(warc.plan_captures(pages), path)
    return warc.assemble(warc.read_records(spark, path))


def test_messy_round_trip(spark, tmp_path):
    known = [row for row in rows() if row[0] is not None]
    path = str(tmp_path / "archives")
    captures = round_trip(spark, spark.createDataFrame(known, SCHEMA), path)
    assert Counter(map(tuple, warc.page_report(captures, "bigint").collect())) == brute(known)
    html = {row[0]: (row[2] or "").encode() for row in known}
    for row in captures.collect():
        fields = dict(line.split(": ", 1) for line in row["metadata"]["block"].decode().strip().split("\r\n"))
        if row["capture"]["type"] == "response":
            assert bytes(row["capture"]["payload"]) == html[int(fields["page-id"])]
        assert row["request"]["block"].startswith(b"GET ")


def test_rows_without_id_and_repeated_rows(spark, tmp_path):
    repeated = [(1, "u", "w" * 200, "", "", "")] * 3 + [row for row in rows() if row[0] is None]
    captures = round_trip(spark, spark.createDataFrame(repeated, SCHEMA), str(tmp_path / "a"))
    found = warc.page_report(captures, "bigint").collect()
    kinds = Counter((row["page_id"], row["record_type"], row["refers_to"]) for row in found)
    assert kinds == {(1, "response", None): 1, (1, "revisit", 1): 2, (None, "response", None): 1, (None, "revisit", None): 1}


def test_archives_are_plain_warc(spark, tmp_path):
    """Walked by the lengths in the headers alone."""
    path = tmp_path / "archives"
    round_trip(spark, spark.createDataFrame(rows(), SCHEMA), str(path))
    kinds = Counter()
    for file in Path(path).glob("*.gz"):
        data, at = gzip.decompress(file.read_bytes()), 0
        while at < len(data):
            assert data.startswith(b"WARC/1.1\r\n", at)
            end = data.index(b"\r\n\r\n", at)
            head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
            at = end + 4 + int(head["Content-Length"])
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
            kinds[head["WARC-Type"]] += 1
    assert kinds["request"] == kinds["metadata"] == len(rows()) == kinds["response"] + kinds["revisit"]


def test_capture_without_its_partners(spark):
    fields = "type STRING, record_id STRING, concurrent_to STRING, refers_to STRING, target_uri STRING, date STRING, content_type STRING, payload_digest STRING, block BINARY, payload BINARY, payload_bytes LONG, payload_sha256 STRING"
    blank = [None] * 5
    records = [
        ("response", "r1", None, *blank, None, b"x", 1, "d"), ("request", "q1", "r1", *blank, b"q", None, None, None),
        ("request", "q0", "r1", *blank, b"q", None, None, None), ("response", "r2", None, *blank, None, b"", 0, "d"),
        ("metadata", "m9", "gone", *blank, b"m", None, None, None), ("metadata", "m8", None, *blank, b"m", None, None, None),
    ]
    found = {row["capture"]["record_id"]: row for row in warc.assemble(spark.createDataFrame(records, fields)).collect()}
    assert set(found) == {"r1", "r2"} and found["r1"]["request"]["record_id"] == "q0" and found["r2"]["request"] is None


def test_query_and_empty(spark, tmp_path):
    assert op10_warc(spark, SMALL).count() == 50
    captures = round_trip(spark, spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert warc.page_report(captures, "bigint").count() == 0
