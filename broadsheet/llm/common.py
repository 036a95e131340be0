"""What several operators share: words, row keys, column checks."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but space and the control characters 09 to 0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def split_words(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text. ``bytes.split`` cuts at exactly the six separators of
    ``WORD_PATTERN``; ``None`` has no words."""
    return text.split() if text else []


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 text in lower-case hex; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that tell rows apart by id and text, nulls included. Rows that agree in both get
    the same key, and every decision made from id and text is the same for them."""
    return F.md5(
        F.concat(
            F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.coalesce(F.concat(F.lit("t"), text), F.lit("n"))
        ).cast("binary")
    )


def binary_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding it."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that clashes with none of df's, upper and lower case alike."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
