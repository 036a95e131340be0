"""WARC archives: writing captures, reading records, assembling transactions.

Each page becomes a transaction of three records: a request, a response (or a revisit of an equal
payload's response) and metadata. Request and metadata name the capture they belong to as
concurrent-to. Reading goes the other way: archives are split into records, and the records of a
transaction are joined through these identifiers into one nested row per capture.

Archives are WARC/1.1 files compressed by gzip, written and read by Spark's text source, whose
line separator is the version line. No record may hold that line inside: a payload that does is
sent in chunks (HTTP chunked transfer coding) that cut it. Each record's length is checked
against its header on reading.

Null html is an empty payload, null urls are left out, and line ends in urls are percent-encoded.
Pages that agree in id and payload are separate captures.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import binary_column
from broadsheet.storage import Workspace

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
# Smaller payloads are stored each time.
REVISIT_FROM = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "2024-01-01T00:00:00Z"


def _record_id(kind: str, page: Column, digest: Column, number: Column) -> Column:
    """A URN that follows from what the record is about, so that a retried task writes the same."""
    code = F.md5(F.concat_ws("|", F.lit(kind), page, digest, number.cast("string")).cast("binary"))
    parts = [F.substring(code, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(fields: list[tuple[str, Column | str]], block: Column) -> Column:
    """Version line, header and block of one record; fields without a value are left out."""
    lines = []
    for name, value in [*fields, ("Content-Length", F.octet_length(block).cast("string"))]:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.concat(F.lit(f"{name}: "), value))
    return F.concat(F.lit(VERSION), F.concat_ws("\r\n", *lines), F.lit(END), block)


def _in_chunks(payload: Column) -> Column:
    """HTTP chunks, cut inside each version line."""
    parts = F.split(payload, r"(?<=WARC/1)(?=\.1(?:\r\n|\z))", -1)
    chunk = F.transform(parts, lambda p: F.concat(F.hex(F.octet_length(p)), F.lit("\r\n"), p, F.lit("\r\n")))
    return F.concat(F.array_join(chunk, ""), F.lit(f"0{END}"))


def plan_captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` rows as captures: which is stored and which revisits another.

    Decisions are made on ids and digests alone; payloads move once, to be joined with them.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("page"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("size"),
        F.sha2(payload.cast("binary"), 256).alias("digest"),
    )
    work = Workspace(pages.sparkSession, "captures")
    each = work.write(rows.groupBy("page", "digest").agg(F.first("id").alias("id")))
    # Tables, so that a payload of very many pages can be split in the join.
    first = work.write(each.groupBy("digest").agg(F.min("id").alias("first_id")))
    plan = each.select("page", "digest").join(first, "digest")
    joined = rows.join(plan, ["page", "digest"])
    # The join's partitioning serves the window: copies of one row are numbered.
    number = F.row_number().over(Window.partitionBy("page", "digest").orderBy("url"))
    stored = (F.col("size") < REVISIT_FROM) | (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("number") == 1))
    return joined.withColumn("number", number).withColumn("stored", stored)


def write_archives(captures: DataFrame, path: str, captured: str = CAPTURED) -> None:
    """Write three records per capture (of ``plan_captures``) into gzip archives below ``path``."""
    page, digest, number = F.col("page"), F.col("digest"), F.col("number")
    # A line end in a url would end its header; a version line must not appear at all.
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), r"WARC/1\.1", "WARC/1%2E1")
    capture_id = _record_id("capture", page, digest, number)
    first_id = _record_id("capture", F.coalesce(F.col("first_id").cast("string"), F.lit("")), digest, F.lit(1))
    stored, payload = F.col("stored"), F.col("payload")
    chunked = payload.rlike(r"WARC/1\.1(?:\r\n|\z)")
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n")
    length = F.concat(F.lit("Content-Length: "), F.col("size").cast("string"), F.lit(END))
    response = (
        F.when(~stored, F.concat(head, length))
        .when(chunked, F.concat(head, F.lit(f"Transfer-Encoding: chunked{END}"), _in_chunks(payload)))
        .otherwise(F.concat(head, length, payload))
    )
    common: list[tuple[str, Column | str]] = [("WARC-Target-URI", url), ("WARC-Date", captured)]
    capture = _record(
        [
            ("WARC-Type", F.when(stored, "response").otherwise("revisit")),
            ("WARC-Record-ID", capture_id),
            *common,
            ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
            ("WARC-Refers-To", F.when(~stored, first_id)),
            ("WARC-Profile", F.when(~stored, PROFILE)),
            ("Content-Type", "application/http;msgtype=response"),
        ],
        response,
    )
    request = _record(
        [
            ("WARC-Type", "request"),
            ("WARC-Record-ID", _record_id("request", page, digest, number)),
            *common,
            ("WARC-Concurrent-To", capture_id),
            ("Content-Type", "application/http;msgtype=request"),
        ],
        F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(f" HTTP/1.1\r\nAccept: */*{END}")),
    )
    metadata = _record(
        [
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", _record_id("metadata", page, digest, number)),
            *common,
            ("WARC-Concurrent-To", capture_id),
            ("Content-Type", "application/warc-fields"),
        ],
        F.concat(F.lit("page-id: "), page, F.lit("\r\npayload-bytes: "), F.col("size").cast("string"), F.lit("\r\n")),
    )
    records = captures.select(F.explode(F.array(request, capture, metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").text(path)


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of what follows a version line."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n"):
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields.get("content-length", -1))
    if size < 0 or rest[size:] not in (b"\r\n\r\n", b""):
        raise ValueError(f"record {fields.get('warc-record-id')} is not as long as its header says")
    return fields, rest[:size]


def http_payload(block: bytes) -> bytes:
    """The entity of an HTTP message, chunks put together."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        at = line + 4 + size


_FIELDS = ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "date", "content_type", "payload_digest")
_HEADERS = (
    "warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date", "content-type",
    "warc-payload-digest",
)


def _parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        heads, blocks, payloads = [], [], []
        for data in binary_column(batch, "value"):
            if not data:  # what stands before an archive's first version line
                continue
            fields, block = parse_record(data)
            http = fields.get("warc-type") == "response" and fields.get("content-type", "").startswith("application/http")
            heads.append([fields.get(name) for name in _HEADERS])
            payloads.append(http_payload(block) if http else None)
            # The payload stands for the block where there is one.
            blocks.append(None if http else block)
        sizes = [None if p is None else len(p) for p in payloads]
        digests = [None if p is None else hashlib.sha256(p).hexdigest() for p in payloads]
        columns = [pa.array([head[i] for head in heads], pa.string()) for i in range(len(_FIELDS))]
        columns += [pa.array(blocks, pa.binary()), pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*_FIELDS, "block", "payload", "payload_bytes", "payload_sha256"])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: header fields, ``block``, and for responses the HTTP
    payload with its length and SHA-256."""
    lines = spark.read.schema("value STRING").option("lineSep", VERSION).text(path)
    fields = ", ".join(f"{name} STRING" for name in _FIELDS)
    return lines.mapInArrow(_parse, f"{fields}, block BINARY, payload BINARY, payload_bytes BIGINT, payload_sha256 STRING")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture`` (response or revisit), and the ``request`` and ``metadata`` records
    that are concurrent to it (null if none is; of several, the first by record id). Records whose payload
    column was dropped give captures without it."""
    captures = records.filter("type IN ('response', 'revisit')")
    side = F.struct("record_id", "target_uri", "date", "content_type", "block")
    others = (
        records.filter("type IN ('request', 'metadata') AND concurrent_to IS NOT NULL")
        .groupBy(F.col("concurrent_to").alias("of"))
        .agg(
            F.min(F.when(F.col("type") == "request", side)).alias("request"),
            F.min(F.when(F.col("type") == "metadata", side)).alias("metadata"),
        )
    )
    nested = captures.select(
        F.col("record_id").alias("id"),
        F.struct(
            *("record_id", "type", "target_uri", "date", "refers_to", "payload_digest"),
            *(name for name in ("payload", "payload_bytes", "payload_sha256") if name in records.columns),
        ).alias("capture"),
    )
    return nested.join(others, F.col("id") == F.col("of"), "left").select("capture", "request", "metadata")


def metadata_field(name: str) -> Column:
    """A field of the metadata record's block."""
    return F.regexp_extract(F.col("metadata.block").cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)


def page_report(assembled: DataFrame, id_type: str) -> DataFrame:
    """Per capture: page, payload size and digest, record type, and the page whose response a revisit refers to.

    A revisit's payload is that of the response it names, found by record id.
    """
    rows = assembled.select(
        F.col("capture.record_id").alias("record_id"),
        metadata_field("page-id").try_cast(id_type).alias("page_id"),
        F.col("capture.payload_bytes").alias("own_bytes"),
        F.col("capture.payload_sha256").alias("own_digest"),
        F.col("capture.type").alias("record_type"),
        F.col("capture.refers_to").alias("refers_to_record"),
    )
    target = rows.filter("record_type = 'response'").select(
        F.col("record_id").alias("target"), F.col("page_id").alias("target_page"),
        F.col("own_bytes").alias("target_bytes"), F.col("own_digest").alias("target_digest"),
    )
    joined = rows.join(target, F.col("refers_to_record") == F.col("target"), "left")
    return joined.select(
        "page_id",
        F.coalesce("own_bytes", "target_bytes").alias("payload_bytes"),
        F.coalesce("own_digest", "target_digest").alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("target_page")).alias("refers_to"),
    )
