"""Removal of long repeated byte strings, by anchors and content hashes.

Every place where a string of ``LENGTH`` bytes starts that also starts elsewhere has to be found.
Bucket-pointer refinement would bucket all suffixes by their first q bytes and refine the buckets,
in rounds, by the bucket identifiers of later offsets. Only its doubling of identifiers is taken
over, inside one text; the rounds are replaced by one anchor per window and hashes of raw bytes:

* identifiers of q-grams are made from those of their halves, identifier(2k, p) from
  identifier(k, p) and identifier(k, p + k), each step reusing the last one for all offsets;
* of the q-grams inside a string the one of smallest identifier, the last of several, stands for
  it. Equal strings choose the same one, so only these anchors are bucketed, one in about 50;
* buckets of one anchor are done. The others are refined by the bytes around the anchor that its
  strings cover: anchors that agree in all of them are settled together;
* where a bucket holds several such classes, one anchor of each is refined by blocks of 16
  starting places: blocks are bucketed by the bytes all their strings share, and in buckets that
  are not alone each string is told by its bytes before and after.

Identifiers of 64 bits only ever put strings into one bucket; what is removed is decided by 128
bits. Texts are UTF-8 bytes read whole, null counting as empty; nothing crosses documents. Texts
of the same content get the same result, so work is keyed by content and copies count once.
Between passes over the documents, a bitmap of fixed size tells which buckets go on; it only
saves work, since joins on exact keys decide.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import binary_column
from broadsheet.storage import Workspace

LENGTH = 200
Q = 100
WINDOW = LENGTH - Q + 1
STEP = 16
CORE = LENGTH - STEP + 1
# Starting places that are handled at once; bounds memory for very long texts.
CHUNK = 1 << 15
# Bits of the filters between passes: 8 MB each, whatever the data size.
FILTER_BITS = 1 << 26

_BYTES = np.random.default_rng(2).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 17) - 1)
_PLACES = _PLACE - np.arange(CHUNK + WINDOW, dtype=np.uint64)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Identifiers of strings from those of their two parts."""
    out = left * _FACTOR
    out += right
    out ^= out >> np.uint64(29)
    return out


def q_grams(data: np.ndarray) -> np.ndarray:
    """An identifier of the Q bytes at each offset."""
    known, size = _BYTES[data], 1
    while 2 * size <= Q:
        known, size = _joined(known[:-size], known[size:]), 2 * size
    rest = Q - size
    return _joined(known[:-rest], known[rest:]) if rest else known


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Identifier and place of each anchor, first and last start of the strings it stands for."""
    parts = []
    for begin in range(0, len(text) - LENGTH + 1, CHUNK):
        data = np.frombuffer(text, np.uint8, min(CHUNK + LENGTH - 1, len(text) - begin), begin)
        ids = q_grams(data)
        # The place in the low bits makes the minimum unique, and the last of equal ones.
        low = ids & ~_PLACE
        low |= _PLACES[: len(ids)]
        size = 1
        while 2 * size <= WINDOW:
            low, size = np.minimum(low[:-size], low[size:]), 2 * size
        low = np.minimum(low[: len(low) - (WINDOW - size)], low[WINDOW - size :])
        first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        last = np.r_[first[1:], len(low)] - 1
        at = (_PLACE - (low[first] & _PLACE)).astype(np.int64)
        parts.append((ids[at], at + begin, first + begin, last + begin))
    if not parts:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(column) for column in zip(*parts))


def text_key(text: bytes) -> tuple[int, int]:
    """128 bits of the content, as two signed longs."""
    return _longs(xxhash.xxh3_128_intdigest(text))


def _longs(number: int) -> tuple[int, int]:
    return tuple(part - (1 << 64) if part >> 63 else part for part in (number >> 64, number & ((1 << 64) - 1)))


def _texts(batch: pa.RecordBatch) -> Counter:
    """The different texts of a batch that are long enough, with their numbers."""
    return Counter(text for text in binary_column(batch, "text") if text and len(text) >= LENGTH)


def _arrays(columns: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values) for _, values in columns], [name for name, _ in columns])


def _count_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each bucket, for one batch at a time."""
    for batch in batches:
        found, times = [], []
        for text, number in _texts(batch).items():
            ids = anchors(text)[0]
            found.append(ids)
            times.append(np.full(len(ids), number))
        if found:
            buckets, where = np.unique(np.concatenate(found), return_inverse=True)
            sums = np.bincount(where, weights=np.concatenate(times)).astype(np.int64)
            yield _arrays([("bucket", buckets.view(np.int64)), ("n", sums)])


def in_filter(ids: np.ndarray, words: np.ndarray) -> np.ndarray:
    place = ids & np.uint64(len(words) * 64 - 1)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def bit_filter(keys: DataFrame, column: str, bits: int):
    """A broadcast bitmap of ``bits`` bits, a power of two, with those of ``column``'s longs set."""
    place = F.col(column).bitwiseAND(bits - 1)
    words = keys.select(place.alias("p")).selectExpr("shiftright(p, 6) AS word", "shiftleft(1L, CAST(p & 63 AS INT)) AS bit")
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    made = np.zeros(bits // 64, np.uint64)
    made[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(made)


def _classes(text: bytes, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[bytes]:
    """For each anchor 128 bits of all bytes that its strings cover, and of its place in them."""
    places = zip(at.tolist(), first.tolist(), last.tolist())
    return [xxhash.xxh3_128_digest(text[s : e + LENGTH], seed=a - s) for a, s, e in places]


def _halves(digests: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of 128 bits as two columns of signed longs."""
    pairs = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


_ANCHOR_FIELDS = ("bucket", "c1", "c2", "t1", "t2", "at", "first", "last", "n")


def _anchor_rows(wanted) -> Callable:
    """The anchors in wanted buckets, with their class and their text's key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text, number in _texts(batch).items():
                ids, at, first, last = anchors(text)
                keep = np.flatnonzero(in_filter(ids, wanted.value))
                if len(keep):
                    at, first, last = at[keep], first[keep], last[keep]
                    t1, t2, n = (np.full(len(keep), value, np.int64) for value in (*text_key(text), number))
                    parts.append((ids[keep].view(np.int64), *_halves(_classes(text, at, first, last)), t1, t2, at, first, last, n))
            if parts:
                yield _arrays(list(zip(_ANCHOR_FIELDS, map(np.concatenate, zip(*parts)))))

    return run


_BLOCK_SCHEMA = "bucket BIGINT, c1 BIGINT, c2 BIGINT, k1 BIGINT, k2 BIGINT, low INT, high INT, base INT, before BINARY, after BINARY"


def _block_rows(wanted) -> Callable:
    """For one anchor of each class in wanted buckets, its blocks of starting places: key of the
    bytes they share, the offsets ``low`` .. ``high`` below ``base`` + 16 that occur, the bytes around."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seen = [], set()
            for text in _texts(batch):
                ids, at, first, last = anchors(text)
                keep = np.flatnonzero(in_filter(ids, wanted.value))
                at, first, last = at[keep], first[keep], last[keep]
                marks = zip(ids[keep].view(np.int64).tolist(), _classes(text, at, first, last))
                for mark, a, s, e in zip(marks, at.tolist(), first.tolist(), last.tolist()):
                    if mark in seen:
                        continue
                    seen.add(mark)
                    # A string that starts l bytes before the anchor; blocks are of 16 values of l.
                    for base in range((a - e) // STEP * STEP, a - s + 1, STEP):
                        core = a - base
                        key = xxhash.xxh3_128_digest(text[core : core + CORE])
                        low, high = max(base, a - e) - base, min(base + STEP - 1, a - s) - base
                        before = text[max(0, core - high) : core]
                        rows.append((*mark, key, low, high, base, before, text[core + CORE : core + CORE + STEP - 1 - low]))
            if rows:
                bucket, mark, key, *rest = zip(*rows)
                columns = [bucket, *_halves(mark), *_halves(key), *rest]
                types = [pa.int64()] * 5 + [pa.int32()] * 3 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, types)],
                    ["bucket", "c1", "c2", "k1", "k2", "low", "high", "base", "before", "after"],
                )

    return run


def _string_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of a block: 128 bits of its content and its start before the anchor."""
    for batch in batches:
        digests, places = [], []
        for k1, k2, low, high, before, after in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6, 8, 9))):
            head, size = b"%d %d " % (k1, k2), len(before)
            starts = range(low, high + 1)
            digests += [xxhash.xxh3_128_digest(b"%s%d %s%s" % (head, i, before[size - i :], after[: STEP - 1 - i])) for i in starts]
            places += starts
        if digests:
            bucket, c1, c2, low, high, base = (batch.column(i).to_numpy() for i in (0, 1, 2, 5, 6, 7))
            mark = [(name, np.repeat(column, high - low + 1)) for name, column in (("bucket", bucket), ("c1", c1), ("c2", c2))]
            s1, s2 = _halves(digests)
            yield _arrays([*mark, ("s1", s1), ("s2", s2), ("l", np.repeat(base, high - low + 1) + np.array(places, np.int64))])


def repeated_spans(texts: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``t1``, ``t2`` (key of a text's content) and ``spans``, the ranges ``start``, ``end`` of bytes of
    repeated strings, not merged, for each text of ``texts`` (``text``) that has any. A text that
    occurs twice repeats all its strings."""
    work = Workspace(texts.sparkSession, "suffix")
    counted = texts.mapInArrow(_count_buckets, "bucket BIGINT, n BIGINT")
    shared = work.write(counted.groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1").select("bucket"))
    several = bit_filter(shared, "bucket", filter_bits)
    anchor_schema = ", ".join(f"{name} BIGINT" for name in _ANCHOR_FIELDS)
    found = texts.mapInArrow(_anchor_rows(several), anchor_schema)
    members = work.write(found.groupBy(*_ANCHOR_FIELDS[:-1]).agg(F.sum("n").alias("n")))
    classes = work.write(members.groupBy("bucket", "c1", "c2").agg(F.sum("n").alias("n")))
    # Buckets with several classes, of which one at least is not settled.
    open_ = work.write(
        classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).filter("classes > 1 AND least = 1").select("bucket")
    )
    blocks = texts.mapInArrow(_block_rows(bit_filter(open_, "bucket", filter_bits)), _BLOCK_SCHEMA)
    blocks = blocks.groupBy("bucket", "c1", "c2", "base").agg(
        *(F.first(name).alias(name) for name in ("k1", "k2", "low", "high", "before", "after"))
    )
    blocks = work.write(blocks.join(open_, "bucket", "left_semi"))
    cores = blocks.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k1", "k2")
    alive = blocks.join(cores, ["k1", "k2"], "left_semi").select("bucket", "c1", "c2", "k1", "k2", "low", "high", "base", "before", "after")
    strings = work.write(alive.mapInArrow(_string_rows, "bucket BIGINT, c1 BIGINT, c2 BIGINT, s1 BIGINT, s2 BIGINT, l BIGINT"))
    again = strings.groupBy("s1", "s2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("s1", "s2")
    single = classes.filter("n = 1").select("bucket", "c1", "c2")
    partly = strings.join(again, ["s1", "s2"], "left_semi").join(single, ["bucket", "c1", "c2"], "left_semi")
    partly = partly.groupBy("bucket", "c1", "c2").agg(F.collect_list("l").alias("starts"))
    decided = classes.filter("n > 1").select("bucket", "c1", "c2", F.expr("CAST(NULL AS ARRAY<BIGINT>)").alias("starts"))
    decided = work.write(decided.unionByName(partly))
    whole = F.array(F.struct(F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end")))
    some = F.transform("starts", lambda l: F.struct((F.col("at") - l).alias("start"), (F.col("at") - l + LENGTH).alias("end")))
    hits = members.join(decided, ["bucket", "c1", "c2"]).withColumn("part", F.when(F.col("starts").isNull(), whole).otherwise(some))
    # As many spans at most as a text has bytes.
    return work.write(hits.groupBy("t1", "t2").agg(F.flatten(F.collect_list("part")).alias("spans")))


def merge_spans(spans: pa.ListArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of each row sorted, overlapping and touching ones joined: where each row's ranges begin (and the
    last one's end), their starts, their ends. ``sizes`` are the lengths of the rows' texts."""
    # Rows are laid out one after another with a gap, so that all are merged at once.
    shift = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])
    moved = np.repeat(shift[:-1], spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    start, end = (part.to_numpy(zero_copy_only=False) + moved for part in spans.flatten().flatten())
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.concatenate([np.ones(min(1, len(start)), bool), start[1:] > reach[:-1]]))
    start, end = start[fresh], reach[np.concatenate([fresh[1:], [len(reach)]])[: len(fresh)] - 1]
    bounds = np.searchsorted(start, shift)
    moved = np.repeat(shift[:-1], np.diff(bounds))
    return bounds, start - moved, end - moved


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per row of docs: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans``, the
    removed ranges of bytes, merged. Only texts that may lose something are moved to their spans."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(text_col).alias("text"))
    spans = repeated_spans(texts, filter_bits)
    wanted = bit_filter(spans, "t1", filter_bits)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text or b"" for text in binary_column(batch, "text")]
            keys = [text_key(text) for text in rows]
            if not rows:
                continue
            t1 = np.array([key[0] for key in keys], np.int64)
            may = in_filter(t1.view(np.uint64), wanted.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(t1),
                    pa.array([key[1] for key in keys], pa.int64()),
                    pa.array([len(text) for text in rows], pa.int64()),
                    pa.array([None if m else hashlib.sha256(text).hexdigest() for m, text in zip(may, rows)], pa.string()),
                    pa.array([text if m else None for m, text in zip(may, rows)], pa.binary()),
                ],
                ["id", "t1", "t2", "n_bytes", "whole", "text"],
            )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, starts, ends = merge_spans(batch.column(4), batch.column(1).to_numpy())
            ranges = list(zip(starts.tolist(), ends.tolist()))
            before = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
            kept = []
            for row, (known, data) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if known is None:
                    rest, at = hashlib.sha256(), 0
                    for start, end in ranges[bounds[row] : bounds[row + 1]]:
                        rest.update(data[at:start])
                        at = end
                    rest.update(data[at:])
                    known = rest.hexdigest()
                kept.append(known)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(before[bounds])),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(kept, pa.string()),
                    pa.ListArray.from_arrays(
                        pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], ["start", "end"])
                    ),
                ],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        keyed, f"id {id_type}, t1 BIGINT, t2 BIGINT, n_bytes BIGINT, whole STRING, text BINARY"
    )
    joined = rows.join(spans, ["t1", "t2"], "left").select("id", "n_bytes", "whole", "text", "spans")
    out = joined.mapInArrow(
        cut,
        f"id {id_type}, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, spans ARRAY<STRUCT<start: BIGINT, end: BIGINT>>",
    )
    return out.withColumnRenamed("id", id_col)
