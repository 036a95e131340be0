"""A positional index: phrases and word distances answered from postings, without reading a text again.

The table ``postings`` says of each word of each document where it stands, and whether exactly one space parts it
from the word before. A document is read in one task, so postings need no shuffle: a row has a word and the documents
of one Arrow batch that hold it, and a task writes what it read, in partitions of ``batch`` and of a bucket of the
word's hash, and in each sorted by word, so that a word's postings are found by partition and by the statistics of
the files' row groups. A word that is in most documents is many rows in many files, written and read by many
tasks. The table ``words`` has the distinct words of a batch, for phrases that begin or end inside a word; ``docs``
has the documents, for what must not occur.

A batch is appended without touching the others, and replaces what an earlier attempt at it left.

Words are runs of letters and digits of the lower-cased text, as in ``filters.near``; a document is named by
any id that is unique over all batches. Null texts have no words.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators.filters import all_close

_WORD = r"[\p{L}\p{N}]+"
# Of the documents that hold a word: their names, and their places one after another up to ``ends``. A place is
# twice the word's number in its document, plus one if it is spaced.
_GATHERED = "word STRING, docs ARRAY<STRING>, ends ARRAY<INT>, places ARRAY<INT>"


def _gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a batch of documents (``doc``, ``words``, ``spaced``), each with the documents that hold it."""

    def starts(*columns: np.ndarray) -> np.ndarray:
        new = np.ones(len(columns[0]), bool)
        new[1:] = np.logical_or.reduce([column[1:] != column[:-1] for column in columns])
        return np.flatnonzero(new)

    for batch in batches:
        words = batch["words"]
        sizes = words.value_lengths().fill_null(0).to_numpy()
        encoded = words.flatten().dictionary_encode()
        if not len(encoded):
            continue
        code = encoded.indices.to_numpy()
        at = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = (2 * at + batch["spaced"].flatten().to_numpy(zero_copy_only=False)).astype(np.int32)
        order = np.argsort(code, kind="stable")
        code, place, row = code[order], place[order], np.repeat(np.arange(len(sizes)), sizes)[order]
        posting = starts(code, row)
        of_word = starts(code[posting])
        first = posting[of_word]
        # Where each word's postings and places begin, and where the last one's end.
        docs, places = np.append(of_word, len(posting)), np.append(first, len(code))
        ends = np.append(posting[1:], len(code)) - np.repeat(first, np.diff(docs))
        columns = [
            encoded.dictionary.take(pa.array(code[first])),
            pa.ListArray.from_arrays(pa.array(docs, pa.int32()), batch["doc"].take(pa.array(row[posting]))),
            pa.ListArray.from_arrays(pa.array(docs, pa.int32()), pa.array(ends, pa.int32())),
            pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(place)),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["word", "docs", "ends", "places"])


class PositionIndex:
    """The index at ``path``. ``buckets`` is fixed once it has rows."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _bucket(self, word: Column) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(self.buckets)).cast("int")

    def append(self, docs: DataFrame, batch: int, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Index the documents of a batch."""
        lower = F.lower(F.col(text_col))
        words = F.regexp_extract_all(lower, F.lit(f"({_WORD})"), F.lit(1))
        gaps = F.regexp_extract_all(lower, F.lit(rf"([^\p{{L}}\p{{N}}]*){_WORD}"), F.lit(1))
        spaced = F.transform(gaps, lambda gap: gap == " ")
        each = docs.select(F.col(id_col).cast("string").alias("doc"), words.alias("words"), spaced.alias("spaced"))
        rows = each.mapInArrow(lambda batches: _gather(batches), _GATHERED).withColumn("bucket", self._bucket(F.col("word")))
        target = f"{self.path}/postings/batch={batch}"
        rows.sortWithinPartitions("bucket", "word").write.mode("overwrite").partitionBy("bucket").parquet(target)
        distinct = self.spark.read.schema("word STRING, bucket INT").parquet(target).select("bucket", "word").distinct()
        distinct.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/words/batch={batch}")
        docs.select(F.col(id_col).cast("string").alias("doc")).write.mode("overwrite").parquet(f"{self.path}/docs/batch={batch}")

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, batch INT").parquet(f"{self.path}/{table}")

    def postings(self) -> DataFrame:
        return self._read("postings", f"{_GATHERED}, bucket INT")

    def _single(self, rows: DataFrame, *columns: str) -> DataFrame:
        """Rows of the table as one row for each word of each document: ``doc``, ``places`` and the columns asked for."""

        def places(doc: Column, i: Column) -> Column:
            before = F.when(i == 0, 0).otherwise(F.get("ends", i - 1))
            return F.struct(doc.alias("doc"), F.slice("places", before + 1, F.get("ends", i) - before).alias("places"))

        return rows.select(*columns, F.explode(F.transform("docs", places)).alias("_one")).select(*columns, "_one.*")

    def docs(self) -> DataFrame:
        return self._read("docs", "doc STRING").select("doc")

    def _of(self, wanted: Sequence[str]) -> DataFrame:
        """Postings of the given words; other partitions are not read."""
        literals = self.spark.range(1).select(*(self._bucket(F.lit(word)) for word in wanted)).first()
        return self.postings().filter(F.col("bucket").isin(*sorted(set(literals))) & F.col("word").isin(*wanted))

    def near(self, terms: Sequence[str], distance: int = 20) -> DataFrame:
        """``doc`` of the documents in which all terms occur within ``distance`` words of each other."""
        wanted = list(dict.fromkeys(term.lower() for term in terms))
        if not all(re.fullmatch(r"[^\W_]+", word) for word in wanted):
            raise ValueError("terms are single words of letters and digits")
        # The group of a document is as small as the list of terms.
        terms = self._single(self._of(wanted), "word").groupBy("doc").agg(F.collect_list(F.struct("word", "places")).alias("terms"))
        found = terms.filter(F.size(F.array_distinct(F.col("terms.word"))) == len(wanted))
        hits = F.flatten(
            F.transform("terms", lambda t: F.transform(t["places"], lambda p: F.struct(F.shiftright(p, 1).alias("at"), t["word"].alias("word"))))
        )
        return found.filter(all_close(F.array_sort(hits), wanted, distance)).select("doc")

    def phrase(self, words: str) -> DataFrame:
        """``doc`` of the documents whose lower-cased text holds the phrase as it stands, inside of words too:
        words of letters and digits with one space between."""
        parts = words.lower().split(" ")
        if not all(re.fullmatch(r"[^\W_]+", part) for part in parts):
            raise ValueError("a phrase is words of letters and digits with one space between")
        last = len(parts) - 1

        def plays(i: int) -> Column:
            """Whether a word can stand at the phrase's place i: the first may be an ending, the last a beginning."""
            word = F.col("word")
            if last == 0:
                return word.contains(parts[0])
            return word.endswith(parts[0]) if i == 0 else word.startswith(parts[i]) if i == last else word == parts[i]

        roles = F.array_compact(F.array(*[F.when(plays(i), F.lit(i)) for i in range(len(parts))]))
        # The buckets of the words that play a part; each row of the postings then tells by its word, without a join.
        known = self._read("words", "word STRING, bucket INT").filter(F.size(roles) > 0).select("bucket").distinct()
        buckets = sorted(row["bucket"] for row in known.collect())
        found = self.postings().filter(F.col("bucket").isin(*buckets)).withColumn("roles", roles).filter(F.size("roles") > 0)
        if last == 0:
            return found.select(F.explode("docs").alias("doc")).distinct()
        each = self._single(found, "roles").select("doc", F.explode("places").alias("p"), "roles")
        each = each.select("doc", F.shiftright("p", 1).alias("at"), F.col("p").bitwiseAND(1).alias("spaced"), F.explode("roles").alias("role"))
        each = each.filter("role = 0 OR spaced = 1")
        # Each place of a document has one word, so a phrase's start is complete with one row per role.
        starts = each.groupBy("doc", (F.col("at") - F.col("role")).alias("start")).agg(F.count(F.lit(1)).alias("n"))
        return starts.filter(F.col("n") == len(parts)).select("doc").distinct()
