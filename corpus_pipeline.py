"""From raw documents to a training mix: five stages, each one operator of ``broadsheet.llm``.

Each stage takes all rows its predecessor kept, as a table, and returns documents with their
columns unchanged; the last one returns what the mix takes of each document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import decontamination, exact_dedup, language_id, mixing, simhash
from broadsheet.llm.rows import keep_decided
from broadsheet.storage import Workspace


# Languages that the mix is made of; None is every language the documents name.
LANGUAGES: frozenset[str] | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of ``LANGUAGES``; texts without letters go, and all if no document names a language."""
    model = language_id.learn(docs.filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model, languages=LANGUAGES)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    groups = exact_dedup.duplicate_groups(docs)
    dropped = groups.filter("NOT kept").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n"))
    return keep_decided(docs, dropped)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (4-word shingles, at most 4 bits), the document with the smallest id."""
    near = simhash.near_duplicates(docs, width=4, distance=4)
    return keep_decided(docs, simhash.not_kept(near))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.mix(docs).report()


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Fingerprints and multinomial draws are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table before the next stage reads it."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = work.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
