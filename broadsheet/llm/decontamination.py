"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of distinct 5-word shingles (powers of two). An item
is sketched by its smallest MinHash values, i.e. its shingles of smallest hash. A document that
holds a share ``containment`` of an item with n shingles misses at most n - ceil(containment * n)
of them, so it must hold one of any n - ceil(containment * n) + 1: the partition's upper bound
gives the sketch length at which no match can be missed, however long the document. Candidates
are verified by exact containment of the shingles themselves.

Words are runs of ASCII letters and digits (A-Z in lower case) and of all characters beyond
ASCII. A text of fewer than five words is one shingle, and an item of so few words is found wherever
a document holds this run of words: documents are probed with runs of each length below five that
occurs among the items. Texts without a word match nothing, null included. Documents are read whole, in one narrow pass and without a shuffle; test items are
taken in blocks of bounded size, each of which is searched against all documents.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import binary_column
from broadsheet.storage import Workspace

WIDTH = 5
CONTAINMENT = 0.8
# Bytes of test items that one pass over the documents searches for.
BLOCK_BYTES = 8_000_000

_SPACED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256)).lower()


def shingles(text: bytes | None, width: int = WIDTH) -> list[bytes]:
    """The shingles of a text in order, repeats included."""
    words = text.translate(_SPACED).split() if text else []
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends)]
    return [joined[a:b] for a, b in zip(starts, ends[width - 1 :])]


def needed(size: int, containment: float) -> int:
    """How many of ``size`` shingles a containing document holds at least."""
    return max(1, math.ceil(size * containment - 1e-9))


def sketch(item: set[bytes], containment: float) -> list[bytes]:
    """The shingles of smallest hash, as many as the item's size partition asks for."""
    upper = 2 ** len(item).bit_length() - 1
    length = upper - needed(upper, containment) + 1
    return sorted(item, key=lambda s: (xxhash.xxh64_intdigest(s), s))[:length]


@dataclass
class Items:
    """A block of test items: their ids, their shingles, which of them a sketch value names, and the numbers of
    words of those that are shorter than a shingle."""

    ids: pa.Array
    shingles: list[set[bytes]]
    index: dict[bytes, list[int]]
    containment: float
    short: list[int]

    def matches(self, text: bytes | None) -> list[tuple[int, int, int]]:
        """Place, size and shared shingles of each item that the text contains."""
        index = self.index
        own = shingles(text)
        for width in self.short:
            own += (s for s in shingles(text, width) if s in index)
        hits = {s for s in own if s in index}
        if not hits:
            return []
        candidates = sorted({item for s in hits for item in index[s]})
        distinct = set(own)
        found = []
        for item in candidates:
            parts = self.shingles[item]
            if len(distinct) >= (least := needed(len(parts), self.containment)):
                shared = len(parts & distinct)
                if shared >= least:
                    found.append((item, len(parts), shared))
        return found


def item_blocks(
    items: DataFrame, id_col: str, text_col: str, containment: float, block_bytes: int = BLOCK_BYTES
) -> Iterator[Broadcast]:
    """The test items in broadcast blocks of about ``block_bytes`` of text, each the fields of ``Items``."""
    spark = items.sparkSession
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0))
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    table = Workspace(spark, "items").write(
        items.select(
            F.col(id_col).alias("item_id"),
            F.col(text_col).cast("binary").alias("text"),
            F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("block"),
        )
    )
    for block in range(blocks):
        rows = table.filter(F.col("block") == block).select("item_id", "text").toArrow()
        sets = [set(shingles(text)) for text in rows.column("text").to_pylist()]
        index: dict[bytes, list[int]] = defaultdict(list)
        for place, parts in enumerate(sets):
            for value in sketch(parts, containment) if parts else ():
                index[value].append(place)
        ids = rows.column("item_id").combine_chunks()
        words = {value.count(b" ") + 1 for parts in sets for value in parts}
        short = sorted(n for n in words if n < WIDTH)
        yield spark.sparkContext.broadcast((ids, sets, dict(index), containment, short))


def contaminations(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    containment: float = CONTAINMENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``item_shingles``, ``shared_shingles``, ``containment`` for each document row and
    test item row of which the document holds at least the given share of distinct shingles."""
    doc_type, item_type = docs.schema[id_col].dataType, items.schema[item_id_col].dataType
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = (
        f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, "
        "item_shingles BIGINT, shared_shingles BIGINT, containment DOUBLE"
    )
    names = ["doc_id", "item_id", "item_shingles", "shared_shingles", "containment"]

    def search(block: Broadcast):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Items(*block.value)
            for batch in batches:
                found = [(row, *m) for row, text in enumerate(binary_column(batch, "text")) for m in known.matches(text)]
                if found:
                    row, item, size, shared = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(row)),
                            known.ids.take(pa.array(item)),
                            pa.array(size, pa.int64()),
                            pa.array(shared, pa.int64()),
                            pa.array([s / n for n, s in zip(size, shared)]),
                        ],
                        names,
                    )

        return texts.mapInArrow(run, schema)

    found = None
    for block in item_blocks(items, item_id_col, item_text_col, containment, block_bytes):
        part = search(block)
        found = part if found is None else found.union(part)
    return found


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    containment: float = CONTAINMENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that contain none of the items, all columns as they are; one narrow pass."""
    clean = docs
    for block in item_blocks(items, item_id_col, item_text_col, containment, block_bytes):
        clean = _without(clean, text_col, block)
    return clean


def _without(docs: DataFrame, text_col: str, block: Broadcast) -> DataFrame:
    @F.pandas_udf("boolean")
    def contains(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Items(*block.value)
        for texts in batches:
            yield texts.map(lambda text: bool(text) and bool(known.matches(text.encode()))).astype(bool)

    return docs.filter(~contains(F.col(text_col)))
