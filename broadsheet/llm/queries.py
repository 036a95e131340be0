"""The registered queries: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    merkle,
    mixing,
    pieces,
    prefix_trie,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    warc,
)
from broadsheet.llm.common import digest
from broadsheet.storage import Workspace


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a model of the four fifths that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"))
    model = language_id.learn(docs.filter(~out))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 200 bytes."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of one and a half times all words takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).report()


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on five or more sources."""
    return line_dedup.report(line_dedup.remove_boilerplate(table(spark, sf_dir, "documents")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, given its text, its source and its language in that source."""
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, documents being repositories and sources their owners."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").drop("secrets")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy of its text that stays."""
    groups = exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint over 4-word shingles and its near-duplicate component."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives it was written to."""
    pages = table(spark, sf_dir, "pages")
    work = Workspace(spark, "warc")
    path = f"{work.path}/archives"
    warc.write_archives(warc.plan_captures(pages), path)
    # The report needs lengths and digests: the archives are parsed once, to a table without payloads.
    captures = warc.assemble(work.write(warc.read_records(spark, path).drop("payload")))
    return warc.page_report(captures, pages.schema["page_id"].dataType.simpleString())


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the conversations, each rebuilt with the head of the first of its five."""
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % 9
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"), donor=conv - conv % 5, head=head, longest_head=8)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in pieces of a public vocabulary, and read back from them."""
    import public_tokenizers

    model = pieces.load_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    spelled = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    covered = F.element_at("bounds", -1) - F.element_at("bounds", 1)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        digest(spelled).alias("ids_sha256"),
        digest(F.col("text")).alias("decoded_sha256"),
        covered.cast("long").alias("n_span_bytes"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document in the manifest, checked after the texts of every other one lost their line ends."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = merkle.leaf_digest([*map(F.col, fields[:-1]), F.translate("text", "\n", "")])
    found = merkle.manifest(docs, fields, "source", "doc_id", {"changed": F.when(tampered, changed)})
    return merkle.verify(found, F.coalesce("changed", "leaf")).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_mixing": op3_mixing,
    "op4_decontamination": op4_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_simhash": op9_simhash,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pieces": op12_pieces,
    "op13_merkle": op13_merkle,
}
