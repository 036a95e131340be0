"""Near-duplicates by SimHash fingerprints, with candidates from pigeonring filtering.

A 64-bit fingerprint is a ring of eight 8-bit segments. If two fingerprints differ in at most
``distance`` = 4 bits, then by the pigeonring principle some segment starts a chain in which the
first l segments together differ in at most l * 4 / 8 bits, for every l from 1 to 8. Such a chain
has at most 3 differing segments among its first seven, so four segments in known places are
equal: those are the index keys. Pairs that meet under a key must show a whole chain before
their full Hamming distance is taken.

Empty and null texts have fingerprint zero and link like any other. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import binary_column, digest, split_words
from broadsheet.llm.components import components
from broadsheet.storage import Workspace

SEGMENTS = 8
BITS = 64 // SEGMENTS
SEED = 42
# Shingles whose bits are counted at once; bounds memory for very long texts.
CHUNK = 1 << 15
# Up to this size the members of a bucket are compared one by one.
SPARSE = 48


def fingerprint(text: bytes | None, width: int) -> int:
    """SimHash of the ASCII-lower-cased words' shingles of ``width``, repeats included: a bit is
    set if it is set in over half of the shingles' XXH64."""
    words = split_words(text.lower() if text else None)
    if not words:
        return 0
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends[:-1])]
    last = ends[width - 1 :] or ends[-1:]
    votes, hash_ = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(last), CHUNK):
        hashes = np.array([hash_(joined[a:b], SEED) for a, b in zip(starts[i : i + CHUNK], last[i : i + CHUNK])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(votes * 2 > len(last)))


def fingerprints(docs: DataFrame, text_col: str = "text", width: int = 4, name: str = "fp") -> DataFrame:
    """``docs`` without its text, but with the fingerprint as a signed long; one narrow pass."""
    rest = [column for column in docs.columns if column != text_col]
    fields = [field for field in docs.schema.fields if field.name != text_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, width) for text in binary_column(batch, text_col)]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(column)) for column in rest] + [signed], [*rest, name]
            )

    schema = ", ".join([*(f"`{field.name}` {field.dataType.simpleString()}" for field in fields), f"`{name}` BIGINT"])
    return docs.mapInArrow(run, schema)


def chain_budgets(distance: int) -> list[int]:
    """Most differing bits of a chain's first l segments, l from 1."""
    return [length * distance // SEGMENTS for length in range(1, SEGMENTS + 1)]


def equal_segments(distance: int) -> list[tuple[int, ...]]:
    """Sets of segments of which one at least is equal in any two linked fingerprints.

    For each start of a chain over all but the last segment, the places where its differing
    segments can lie within the budgets; what is left over is equal.
    """
    budgets = chain_budgets(distance)
    reach = SEGMENTS - 1
    most = budgets[reach - 1]
    found = set()
    for start in range(SEGMENTS):
        for differing in combinations(range(reach), most):
            if all(sum(place < length for place in differing) <= budgets[length - 1] for length in range(1, reach + 1)):
                found.add(tuple(sorted((start + place) % SEGMENTS for place in range(reach) if place not in differing)))
    return sorted(found)


def _mask(segments: Iterable[int]) -> int:
    return sum(((1 << BITS) - 1) << (BITS * segment) for segment in segments)


def has_chain(differing: np.ndarray, distance: int) -> np.ndarray:
    """Whether some start has a chain whose every prefix stays within its budget."""
    parts = np.stack([np.bitwise_count((differing >> np.uint64(BITS * k)) & np.uint64(255)) for k in range(SEGMENTS)])
    parts = parts.astype(np.int16)
    any_start = np.zeros(differing.shape, bool)
    for start in range(SEGMENTS):
        sums = np.cumsum(np.roll(parts, -start, axis=0), axis=0)
        any_start |= np.all(sums <= np.array(chain_budgets(distance))[:, None], axis=0)
    return any_start


def _compare(keys: np.ndarray, prints: np.ndarray, distance: int, sparse: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links among rows sorted by key, and the fingerprints of buckets too large for pairs."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[first, len(keys)])
    size = np.repeat(sizes, sizes)
    dense = prints[size > sparse]
    small = (size > 1) & (size <= sparse)
    keys, prints = keys[small], prints[small]
    left, right = [], []
    for step in range(1, sparse):
        meet = np.flatnonzero(keys[step:] == keys[:-step]) if len(keys) > step else []
        if not len(meet):
            break
        a, b = prints[meet], prints[meet + step]
        on_ring = has_chain(a ^ b, distance)
        a, b = a[on_ring], b[on_ring]
        near = np.bitwise_count(a ^ b) <= distance
        left.append(a[near])
        right.append(b[near])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), dense


def _bucket_links(distance: int, sparse: int):
    """Over rows (k, v, fp) sorted by (k, v): links as (a, b), members of large buckets as (a, null)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: np.ndarray) -> pa.RecordBatch:
            left, right, dense = _compare(rows[:, 0], rows[:, 1], distance, sparse)
            a = np.concatenate([left, dense]).view(np.int64)
            b = pa.array(np.concatenate([right, dense]).view(np.int64), mask=np.arange(len(a)) >= len(left))
            return pa.RecordBatch.from_arrays([pa.array(a), b], ["a", "b"])

        # Batches are cut at a change of key. A bucket that outgrows the buffer is known to be
        # large; its rows are emitted as such and only its key is remembered.
        held, large = np.zeros((0, 2), np.uint64), None
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)], axis=1)
            if large is not None:
                more = rows[:, 0] == large
                if more.any():
                    a = pa.array(rows[more, 1].view(np.int64))
                    yield pa.RecordBatch.from_arrays([a, pa.nulls(len(a), pa.int64())], ["a", "b"])
                    rows = rows[~more]
                if len(rows):
                    large = None
            held = np.concatenate([held, rows])
            if not len(held):
                continue
            cut = int(np.searchsorted(held[:, 0].view(np.int64), held[-1, 0].view(np.int64)))
            if len(held) - cut > sparse:
                large, cut = held[-1, 0], len(held)
            yield emit(held[:cut])
            held = held[cut:]
        if len(held):
            yield emit(held)

    return run


def _centres(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint with all values within two bits of it."""
    one = np.uint64(1)
    single = one << np.arange(64, dtype=np.uint64)
    i, j = np.triu_indices(64, 1)
    flips = np.concatenate([np.zeros(1, np.uint64), single, single[i] | single[j]])
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for at in range(0, len(prints), 64):
            part = prints[at : at + 64]
            centre = (part[:, None] ^ flips[None, :]).ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(centre.view(np.int64)), pa.array(np.repeat(part, len(flips)).view(np.int64))], ["centre", "fp"]
            )


def links(prints: DataFrame, distance: int = 4, sparse: int = SPARSE) -> DataFrame:
    """Links ``a``, ``b`` among the distinct fingerprints of ``prints`` (``fp``) that join all within
    ``distance`` bits: each such pair is linked or connected through others.

    Small buckets are compared pair by pair. The members of a bucket of more than ``sparse`` are
    handled without pairs, for distance 4: two of them are within four bits exactly if some value
    is within two bits of both. Each member is listed under all 2,081 values within two bits, and
    neighbours in a value's list are linked. No list can be longer than 2,081, so no task grows
    with the size of a group of near-copies, and the work is proportional to its members.
    """
    if distance != 4:
        raise ValueError("links are derived for a distance of 4 bits")
    work = Workspace(prints.sparkSession, "simhash")
    masks = [_mask(segments) for segments in equal_segments(distance)]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    distinct = work.write(prints.select("fp").distinct())
    keyed = distinct.select(
        "fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(mask)) for mask in signed))).alias("no", "part")
    )
    # The key holds mask number and masked bits; xxhash64 mixes both into one long. Two keys that
    # fall together only bring more candidates.
    keyed = keyed.select(F.xxhash64("no", "part").alias("k"), "fp")
    sorted_ = keyed.repartition("k").sortWithinPartitions("k", "fp")
    found = work.write(sorted_.mapInArrow(_bucket_links(distance, sparse), "a BIGINT, b BIGINT"))
    pairs = found.filter("b IS NOT NULL")
    dense = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    listed = dense.mapInArrow(_centres, "centre BIGINT, fp BIGINT")
    near = listed.repartition("centre").sortWithinPartitions("centre", "fp").mapInArrow(_neighbours, "a BIGINT, b BIGINT")
    return pairs.union(near).distinct()


def _neighbours(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by centre, each two in a row under the same centre."""
    last = np.zeros((0, 2), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
        rows = np.concatenate([last, rows])
        if not len(rows):
            continue
        same = rows[1:, 0] == rows[:-1, 0]
        found = np.unique(np.stack([rows[:-1, 1][same], rows[1:, 1][same]], axis=1), axis=0)
        last = rows[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, distance: int = 4
) -> DataFrame:
    """One row per row of docs: ``id_col``, ``digest`` of the text, ``fp``, ``component`` (its smallest fingerprint)
    and ``component_id``, the smallest id reachable over links (null if no row of the component has
    an id). Rows with equal fingerprints are linked; they take part in the search once."""
    work = Workspace(docs.sparkSession, "near")
    rows = docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    marked = work.write(fingerprints(rows, "text", width))
    prints = work.write(marked.groupBy("fp").agg(F.min("id").alias("least")))
    member = components(links(prints, distance)).withColumnRenamed("node", "fp")
    # Tables, so that a component of very many fingerprints or rows can be split in the joins.
    placed = work.write(prints.join(member, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    smallest = work.write(placed.groupBy("component").agg(F.min("least").alias("component_id")))
    named = work.write(placed.join(smallest, "component").select("fp", "component", "component_id"))
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "digest", "fp", "component", "component_id")


def not_kept(near: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What goes if one row of each component stays, the one of smallest id (nulls last), then digest:
    ``id``, ``digest``, ``n`` of the rows that agree in both."""
    work = Workspace(near.sparkSession, "stay")
    rows = work.write(near.groupBy("component", F.col(id_col).alias("id"), "digest").agg(F.count(F.lit(1)).alias("n")))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("digest"))
    best = work.write(rows.groupBy("component").agg(F.min_by(F.struct("id", "digest"), order).alias("best")))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    left = rows.join(best, "component").withColumn("n", F.col("n") - F.when(stays, 1).otherwise(0))
    return left.filter("n > 0").groupBy("id", "digest").agg(F.sum("n").alias("n"))
