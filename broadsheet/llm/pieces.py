"""Encoding texts into the pieces of a SentencePiece BPE model, and decoding them, with source spans.

A text is normalised by the model's compiled character map: at each byte the longest prefix that the
map knows is replaced, any other character stays, and for each normalised character the byte it came
from is recorded. The normalised text is cut where no piece can cross, before a run of spaces. The
segments of many texts are merged together, one pair of each at a time, best score first, leftmost
first; segments of more than 64 characters are merged by a heap of pairs. Every piece is projected to
the bytes of the original text by the recorded alignment; characters without a piece become byte
pieces, of which the last one has the character's span and the others an empty one.

Defined cases: null counts as empty and has no pieces but the end id; whole texts of any length are
read, in windows of about a million characters where the model has no character map, in time of
n log n at worst; equal texts give equal pieces; an empty table has no rows; columns not named are not
read, whatever their names. Models other than BPE, and models with user-defined or unused pieces, are
refused.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The format's space symbol, kinds of pieces, and what an unknown id or byte reads as.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_SURFACE = " ⁇ "
REPLACEMENT = "�"

# A model file is a vocabulary: it does not grow with the data. Larger ones are refused, not broadcast.
MAX_MODEL_BYTES = 64 << 20
# Up to this length segments are merged together, as arrays; both ways give the same parts.
SHORT = 64
NO_PAIR = 1 << 30
# A symbol is a piece's id, or, for a character without piece, its code point after the last id.
SYMBOL_BITS = 22
# Characters that are worked on at once.
WINDOW = 1 << 20
# Rows that are decoded at once.
DECODE_ROWS = 256


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one serialised message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        wire = tag & 7
        if wire == 0:
            value, at = number(at)
            yield tag >> 3, value
            continue
        size, at = number(at) if wire == 2 else ({1: 8, 5: 4}[wire], at)
        yield tag >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """A compiled character map: a double-array trie over source bytes and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = array("I", blob[4 : 4 + size])
        self.texts = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length and replacement of the longest prefix of ``data[at:]`` in the map."""
        units, found = self.units, None
        node = 0
        unit = units[0]
        for end in range(at, len(data)):
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            node ^= data[end]
            unit = units[node]
            if unit & 0x800000FF != data[end]:
                break
            if unit >> 8 & 1:
                child = node ^ (unit >> 10) << ((unit & 512) >> 6)
                found = end + 1 - at, units[child] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.texts[start : self.texts.index(0, start)].decode()


def compile_model(data: bytes) -> dict:
    """What tasks need of a model file, in built-in types and arrays."""
    pieces, kinds, scores = [], [], []
    trainer, normaliser = {}, {}
    for field, value in message_fields(data):
        if field == 1:
            piece = dict(message_fields(value))
            pieces.append(piece.get(1, b"").decode())
            scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
            kinds.append(piece.get(3, NORMAL))
        elif field == 2:
            trainer = dict(message_fields(value))
        elif field == 3:
            normaliser = dict(message_fields(value))
    if trainer.get(3, 1) != 2 or trainer.get(24, 0) or {USER_DEFINED, UNUSED} & set(kinds):
        raise ValueError("only BPE models with normal, control, unknown and byte pieces")
    # Equal scores share a rank: among them the leftmost pair is merged first.
    order = {score: rank for rank, score in enumerate(sorted(set(scores), reverse=True))}
    ids = {piece: i for i, piece in enumerate(pieces) if kinds[i] == NORMAL}
    pairs = {}
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = (ids.get(part, len(pieces) + ord(part) if len(part) == 1 else None) for part in (piece[:cut], piece[cut:]))
            if left is not None and right is not None:
                pairs[left << SYMBOL_BITS | right] = i
    keys = np.array(sorted(pairs), np.int64)
    joined = np.array([pairs[key] for key in keys.tolist()], np.int64)
    ranks = np.array([order[score] for score in scores], np.int64)
    return {
        "pieces": pieces,
        "kinds": kinds,
        "ranks": ranks,
        "pair_keys": np.append(keys, np.iinfo(np.int64).max),
        "pair_ids": np.append(joined, -1),
        "pair_ranks": np.append(ranks[joined], NO_PAIR),
        "map": normaliser.get(2, b""),
        **{name: bool(normaliser.get(field, 1)) for name, field in (("dummy_prefix", 3), ("trim", 4), ("escape", 5))},
    }


class PieceModel:
    """Encodes and decodes with what ``compile_model`` returns."""

    def __init__(self, tables: dict):
        self.pieces: list[str] = tables["pieces"]
        self.kinds: list[int] = tables["kinds"]
        self.tables = tables
        self.map = CharacterMap(tables["map"]) if tables["map"] else None
        self.dummy_prefix, self.trim, self.escape = (tables[name] for name in ("dummy_prefix", "trim", "escape"))
        self.ids = {piece: i for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == NORMAL}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i, kind in enumerate(self.kinds) if kind == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = self.pieces.index("</s>") if "</s>" in self.pieces else None
        # Where a piece holds a space after another character, segments would not be independent.
        self.whole = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids)
        self.segments = re.compile("(?s:.+)" if self.whole else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.symbols = np.arange(0x110000, dtype=np.int64) + len(self.pieces)
        single = [(ord(piece), i) for piece, i in self.ids.items() if len(piece) == 1]
        self.symbols[[point for point, _ in single]] = [i for _, i in single]
        self.surfaces = [self._surface(i) for i in range(len(self.pieces))]
        # A byte that starts no character is replaced, and the next one looked at.
        codecs.register_error("replace one byte", lambda error: (REPLACEMENT, error.start + 1))

    def _surface(self, i: int) -> str | None:
        """What an id reads as inside a text; ``None`` for a byte."""
        kind = self.kinds[i]
        if kind in (CONTROL, UNKNOWN):
            return "" if kind == CONTROL else UNKNOWN_SURFACE
        return None if kind == BYTE else self.pieces[i].replace(SPACE, " ")

    def windows(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """The normalised text in windows that no piece crosses, each with the byte of ``text`` that each of its
        characters starts at, and that it ends at."""
        if self.map or self.trim or self.whole:
            yield self.normalise(text)
            return
        space = SPACE if self.escape else " "
        low = base = 0
        while low < len(text):
            high = min(low + WINDOW, len(text))
            while high < len(text) and (text[high] not in (" ", SPACE) or text[high - 1] in (" ", SPACE)):
                high += 1
            part = text[low:high]
            prefix = self.dummy_prefix and low == 0
            starts = np.full(len(part) + 1 + prefix, base, np.int64)
            np.cumsum(_byte_widths(part), out=starts[1 + prefix :])
            starts[1 + prefix :] += base
            yield space * prefix + part.replace(" ", space), starts
            low, base = high, int(starts[-1])

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters, and for its end, the byte of ``text`` it starts at."""
        space = SPACE if self.escape else " "
        chunks: list[tuple[str, int]] = []
        data = text.encode()
        at = 0
        while at < len(data):
            found = self.map.longest(data, at) if self.map else None
            if found is None:
                first = data[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                found = size, data[at : at + size].decode()
            chunks.append((found[1], at))
            at += found[0]
        end = len(data)
        if self.trim:
            lead = 0
            while lead < len(chunks) and chunks[lead][0] == " ":
                lead += 1
            chunks = chunks[lead:]
        if not chunks:
            return "", np.array([end])
        out, starts = [], []
        if self.dummy_prefix:
            out.append(space)
            starts.append(chunks[0][1])
        after_space = self.trim
        for chunk, start in chunks:
            if after_space:
                chunk = chunk.lstrip(" ")
            if chunk:
                out.append(chunk.replace(" ", space))
                starts.extend([start] * len(chunk))
                after_space = self.trim and chunk.endswith(" ")
        normal = "".join(out)
        if self.trim:
            while normal.endswith(space):
                normal = normal[: -len(space)]
                end = starts[len(normal)]
        return normal, np.array([*starts[: len(normal)], end])

    def _merge_together(self, symbols: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and places of many segments (of ``sizes`` symbols each), in no order."""
        keys, ids, ranks = (self.tables[name] for name in ("pair_keys", "pair_ids", "pair_ranks"))

        def pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            key = left << SYMBOL_BITS | right
            slot = np.searchsorted(keys, key)
            return np.where(keys[slot] == key, slot, len(keys) - 1)

        none = len(keys) - 1
        slots = np.append(pairs(symbols[:-1], symbols[1:]), none) if len(symbols) else np.empty(0, np.int64)
        if len(sizes):
            slots[np.cumsum(sizes) - 1] = none
        done = []
        while len(sizes):
            # The best pair of each segment, the leftmost of equal ones.
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(ranks[slots] << 32 | np.arange(len(slots)), starts)
            going = best >> 32 != NO_PAIR
            if not going.all():
                kept = np.repeat(going, sizes)
                done.append((symbols[~kept], places[~kept]))
                shift = np.cumsum(np.where(going, 0, sizes))[going]
                symbols, places, slots, sizes = symbols[kept], places[kept], slots[kept], sizes[going]
                best = best[going]
                at = (best & 0xFFFFFFFF) - shift
                if not len(sizes):
                    break
            else:
                at = best & 0xFFFFFFFF
            symbols[at] = ids[slots[at]]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            # The pair to the right of the merged one takes its place; both neighbours are looked up anew.
            last = at + 1 == np.cumsum(sizes) - 1
            symbols, places, slots, sizes = symbols[kept], places[kept], slots[kept], sizes - 1
            at -= np.arange(len(at))
            starts = np.cumsum(sizes) - sizes
            slots[at[last]] = none
            inner = at[~last]
            slots[inner] = pairs(symbols[inner], symbols[inner + 1])
            right = at[at > starts]
            slots[right - 1] = pairs(symbols[right - 1], symbols[right])
        return tuple(np.concatenate([part[i] for part in done] or [np.empty(0, np.int64)]) for i in (0, 1))

    def _merge_long(self, segment: str) -> list[str]:
        """The parts of one segment, by a heap of pairs and links between the parts."""
        ranks, ids, parts = self.tables["ranks"], self.ids, list(segment)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap = [(int(ranks[ids[a + b]]), i, i + 1, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids]
        heapq.heapify(heap)
        while heap:
            _, left, right, joined = heapq.heappop(heap)
            if not parts[left] or after[left] != right or parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, ""
            far = after[left] = after[right]
            if far < len(parts):
                before[far] = left
            for a, b in ((before[left], left), (left, far)):
                if a >= 0 and b < len(parts):
                    pair = parts[a] + parts[b]
                    if pair in ids:
                        heapq.heappush(heap, (int(ranks[ids[pair]]), a, b, pair))
        return [part for part in parts if part]

    def _merge_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of different segments the ids and, for each, the character of the segment it starts at, one segment after
        another, and the number of ids of each."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(segment) for segment in segments], np.int64)
        firsts = np.cumsum(sizes) - sizes
        short = sizes <= SHORT
        inside = np.repeat(short, sizes)
        symbols, places = self._merge_together(self.symbols[points[inside]], np.flatnonzero(inside), sizes[short])
        for i in np.flatnonzero(~short).tolist():
            parts = self._merge_long(segments[i])
            found = [self.ids[part] if part in self.ids else len(self.pieces) + ord(part) for part in parts]
            symbols = np.append(symbols, found)
            places = np.append(places, firsts[i] + np.cumsum([0, *map(len, parts[:-1])]))
        order = np.argsort(places)
        ids, places = symbols[order], places[order]
        foreign = ids >= len(self.pieces)
        if self.bytes:
            spelled = [chr(point).encode() for point in (ids[foreign] - len(self.pieces)).tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[foreign] = [len(raw) for raw in spelled]
            ids, places, foreign = (np.repeat(x, counts) for x in (ids, places, foreign))
            ids[foreign] = np.array([self.bytes[byte] for byte in range(256)])[np.frombuffer(b"".join(spelled), np.uint8)]
        else:
            ids[foreign] = self.unknown
        owner = np.searchsorted(firsts, places, "right") - 1
        return ids, places - firsts[owner], np.bincount(owner, minlength=len(segments))

    def _encode_window(self, texts: list[str], starts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte each piece starts at, and the number of pieces of each text."""
        numbers: dict[str, int] = {}
        which, per_text = [], []
        for text in texts:
            found = self.segments.findall(text)
            which += [numbers.setdefault(segment, len(numbers)) for segment in found]
            per_text.append(len(found))
        if not which:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        # Each different segment is merged once, and its pieces are copied to where it stands.
        ids, places, counts = self._merge_segments(list(numbers))
        which = np.array(which)
        lengths = np.array([len(segment) for segment in numbers], np.int64)[which]
        pieces = counts[which]
        before = np.cumsum(pieces) - pieces
        copy = np.repeat((np.cumsum(counts) - counts)[which] - before, pieces) + np.arange(pieces.sum())
        at = places[copy] + np.repeat(np.cumsum(lengths) - lengths, pieces)
        totals = np.add.reduceat(pieces, np.cumsum(per_text) - per_text)
        return ids[copy], np.concatenate([start[:-1] for start in starts])[at], totals

    def encode_all(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of many texts the ids and, for each, the byte it starts at, one after another, the number of ids of
        each text, and its bytes."""
        held, bounds, owners, chars = [], [], [], 0
        parts, counts, sizes = [], [], []

        def flush() -> None:
            ids, starts, per_part = self._encode_window(held, bounds)
            parts.append((ids, starts))
            for owner, n in zip(owners, per_part.tolist()):
                counts[owner] += n
            held.clear(), bounds.clear(), owners.clear()

        for number, text in enumerate(texts):
            counts.append(0)
            sizes.append(0)
            for normal, starts in self.windows(text):
                if normal:
                    held.append(normal)
                    bounds.append(starts)
                    owners.append(number)
                    chars += len(normal)
                sizes[number] = int(starts[-1])
                if chars >= WINDOW:
                    flush()
                    chars = 0
        flush()
        ids, starts = (np.concatenate([part[i] for part in parts]) for i in (0, 1))
        return ids, starts, np.array(counts, np.int64), np.array(sizes, np.int64)

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of one text, and the bytes at which each piece starts and, last, where the final one ends."""
        ids, starts, _, size = self.encode_all([text])
        return ids.tolist(), [*starts.tolist(), int(size[0])]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a sequence of ids."""
        surfaces, kinds = self.surfaces, self.kinds
        out: list[str] = []
        raw = bytearray()
        # Until something is read, one space symbol at the start of a piece is the dummy prefix.
        dummy = self.dummy_prefix or self.trim
        for i in ids:
            surface = surfaces[i]
            if surface is None:
                raw.append(int(self.pieces[i][3:5], 16))
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace one byte"))
                raw.clear()
                dummy = False
            if dummy and kinds[i] != CONTROL:
                dummy = False
                if kinds[i] == NORMAL and surface.startswith(" "):
                    surface = surface[1:]
            out.append(surface)
        return "".join(out) + raw.decode("utf-8", "replace one byte")


def _byte_widths(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)


def load_model(spark: SparkSession, path: str):
    """The model file, read and compiled on the driver, and broadcast: about ten times its size."""
    with open(path, "rb") as file:
        data = file.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} is no vocabulary: more than {MAX_MODEL_BYTES} bytes")
    return spark.sparkContext.broadcast(compile_model(data))


def _slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch with some values each, so that memory does not grow with the batch."""
    total = np.concatenate([[0], np.cumsum(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)])
    start = 0
    while start < len(column):
        end = max(start + 1, bisect_right(total, total[start] + limit) - 1)
        yield start, end
        start = end


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _encoder(model, add_end: bool) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel(model.value)
        for batch in batches:
            for low, high in _slices(batch.column(1), WINDOW):
                part = batch.slice(low, high - low)
                ids, starts, counts, sizes = pieces.encode_all(text or "" for text in part.column(1).to_pylist())
                ends = np.cumsum(counts)
                if add_end:
                    # The end id stands for nothing, after the last byte.
                    ids, starts, counts = np.insert(ids, ends, pieces.end), np.insert(starts, ends, sizes), counts + 1
                    ends = np.cumsum(counts)
                bounds = np.insert(starts, ends, sizes)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids, counts), _lists(bounds, counts + 1)], ["id", "ids", "bounds"])

    return run


def encode(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", add_end: bool = True) -> DataFrame:
    """One row per row of docs: ``id``, ``ids`` and ``bounds``: piece i stands for the bytes of the text from bounds[i] up to bounds[i + 1].

    ``model`` is what ``load_model`` returns. One narrow pass, no shuffle.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _encoder(model, add_end), f"id {id_type}, ids ARRAY<INT>, bounds ARRAY<INT>"
    )


def _decoder(model) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceModel(model.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            known = column.is_valid().to_pylist()
            # Some rows at a time, as their texts take more room than their ids.
            for low in range(0, len(column), DECODE_ROWS):
                part = batch.slice(low, DECODE_ROWS)
                bounds = column.offsets[low : low + part.num_rows + 1].to_pylist()
                values = column.values[bounds[0] : bounds[-1]].to_numpy(zero_copy_only=False)
                texts = [
                    pieces.decode(values[a - bounds[0] : b - bounds[0]].tolist()) if there else None
                    for a, b, there in zip(bounds, bounds[1:], known[low:])
                ]
                yield part.append_column("text", pa.array(texts, pa.string()))

    return run


def decode(encoded: DataFrame, model) -> DataFrame:
    """``encoded`` (``ids`` and any more columns but ``text``) with the ``text`` that the ids stand for."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(_decoder(model), f"{schema}, text STRING")
