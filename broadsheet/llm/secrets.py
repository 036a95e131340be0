"""Secret scan with corpus-wide ownership frequency.

Three kinds of base spans are found by pattern: assigned secrets, access keys and long hex runs.
Beside them, opaque tokens are candidates: long runs of letters and digits that mix both and have
high entropy. All candidate values are hashed and counted over the corpus by distinct
repositories and owners. A value that several owners have is a widely copied example; one that
stays with its owner looks live. Opaque tokens count as secrets only if they look live in this
sense; base spans always do, and carry the same verdict.

Spans are code points, end exclusive. Null text counts as empty, a null owner or repository as
one more of its kind. Whole texts are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.storage import Workspace

KINDS = ("assign", "access", "hex", "token")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}")
# Without one of these words, in any case, ASSIGN cannot match.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
# From so many owners on a value is a copied example.
EXAMPLE_OWNERS = 3
TOKEN_ENTROPY = 3.5


def entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Start, kind, end and value of each base span, sorted by start, then kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        # The minimum length is tested on matches, not in the pattern: a short match still uses up its text.
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def token_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Opaque tokens that no base span touches. Both lists are in the order of their starts: one pass over each."""
    found = []
    place, reached = 0, -1
    for m in TOKEN.finditer(text):
        # How far the base spans reach that start before this token ends.
        while place < len(taken) and taken[place][0] < m.end():
            reached = max(reached, taken[place][2])
            place += 1
        value = m[0]
        mixed = any(map(str.isdigit, value)) and any(map(str.isalpha, value))
        if reached <= m.start() and mixed and entropy(value) >= TOKEN_ENTROPY:
            found.append((m.start(), 3, m.end(), value))
    return found


def span_text(spans: Iterable[tuple]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in spans)


_CANDIDATES = "ARRAY<STRUCT<start: BIGINT, kind: INT, end: BIGINT, value: BINARY>>"
_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("value", pa.binary())]))


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, candidates = [], [], []
        for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
            base = base_spans(text) if text else []
            every = sorted(base + (token_spans(text, base) if text else []))
            counts.append(Counter(kind for _, kind, _, _ in base))
            digests.append(hashlib.sha256(span_text(base).encode()).hexdigest())
            candidates.append(
                [(s, kind, e, hashlib.sha256(value.encode()).digest()[:16]) for s, kind, e, value in every]
            )
        numbers = [pa.array([count[kind] for count in counts], pa.int64()) for kind in range(3)]
        rows = pa.array([[dict(zip(("start", "kind", "end", "value"), c)) for c in row] for row in candidates], _ARROW)
        kept = [batch.column(batch.schema.get_field_index(name)) for name in ("id", "repository", "owner")]
        yield pa.RecordBatch.from_arrays(
            [*kept, *numbers, pa.array(digests, pa.string()), rows],
            ["id", "repository", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "candidates"],
        )


def ownership(candidates: DataFrame) -> DataFrame:
    """``value``, ``repositories``, ``owners`` for rows (``value``, ``repository``, ``owner``).

    Three aggregations with partial sums before each shuffle, so a value that a third of all
    documents share is counted in pieces.
    """
    each = candidates.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = each.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repository_col: str = "doc_id",
    owner_col: str = "source",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """One row per row of docs: ``id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` (all, as text), ``n_live``
    and ``n_example`` (of all spans) and ``secrets``, the spans as structs with ``repositories`` and ``owners``."""
    work = Workspace(docs.sparkSession, "secrets")
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(repository_col).cast("string"), F.lit("")).alias("repository"),
        F.coalesce(F.concat(F.lit("o"), F.col(owner_col).cast("string")), F.lit("")).alias("owner"),
        F.col(text_col).alias("text"),
    )
    id_type = docs.schema[id_col].dataType.simpleString()
    scanned = rows.mapInArrow(
        _scan,
        f"id {id_type}, repository STRING, owner STRING, n_assign BIGINT, n_access BIGINT, n_hex BIGINT, "
        f"base_sha256 STRING, candidates {_CANDIDATES}",
    )
    found = work.write(scanned.withColumn("row", F.monotonically_increasing_id()))
    each = found.select("row", "repository", "owner", F.inline("candidates"))
    verdicts = work.write(ownership(each.select("value", "repository", "owner")))
    example = F.col("owners") >= example_owners
    judged = each.select("row", "start", "kind", "end", "value").join(verdicts, "value")
    judged = judged.filter((F.col("kind") < 3) | ~example).withColumn("live", ~example)
    # As many spans at most as a text has room for.
    spans = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live", "repositories", "owners"))).alias("secrets")
    )
    kinds = F.array(*map(F.lit, KINDS))
    text = F.transform("secrets", lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    out = found.drop("candidates").join(spans, "row", "left")
    live = F.size(F.filter(F.coalesce("secrets", F.array()), lambda s: s["live"])).cast("long")
    return out.select(
        "id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(F.array_join(text, ","), F.lit("")).alias("spans"),
        live.alias("n_live"),
        (F.size(F.coalesce("secrets", F.array())).cast("long") - live).alias("n_example"),
        "secrets",
    )
