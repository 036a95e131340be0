"""Published lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.rank import number_top, source_lines

STAGES = ("pre_filtered", "raw", "final")
COLUMNS = ("idx", "title", "url", "domain", "seendate", "api_source", "tier", "reasoning", "ord")


def publish(df: DataFrame, path: str, stage: str, run_ts: str, cap: int | None = None, enabled: bool = True) -> None:
    """Write one stage of a run as a numbered table under ``run_ts=…/stage=…``, in place of what an earlier
    attempt at the same run left there.

    Whole stages are numbered without gathering them. The pre-filtered stage also replaces the
    ``latest`` snapshot by its rows. The first two stages can be switched off; an empty one writes
    nothing.
    """
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    if stage != "final":
        if not enabled or df.isEmpty():
            return
    numbered = number_top(df, cap).select(*COLUMNS)
    target = f"{path}/lists/run_ts={run_ts}/stage={stage}"
    numbered.write.mode("overwrite").parquet(target, compression="zstd")
    if stage == "pre_filtered":
        written = df.sparkSession.read.schema(numbered.schema).parquet(target)
        written.write.mode("overwrite").parquet(f"{path}/latest", compression="zstd")


def publish_text(numbered: DataFrame, path: str) -> None:
    """Write the printed three lines per article, files in ``idx`` order."""
    ordered = source_lines(numbered).repartitionByRange("idx").sortWithinPartitions("idx")
    ordered.select("line").write.mode("errorifexists").text(path)


def triage_prompt(df: DataFrame, cap: int) -> DataFrame:
    """One row: the numbered list of the first ``cap`` articles as a reviewer reads it."""
    shown = number_top(df, cap).withColumn("i", F.col("idx") - 1)
    line = F.format_string("[%d] (%s): %s", F.col("i"), F.col("domain"), F.col("title"))
    lines = F.array_sort(F.collect_list(F.struct("i", line.alias("line"))))
    return shown.agg(F.array_join(F.transform(lines, lambda entry: entry["line"]), "\n").alias("items"))


def review_text(df: DataFrame) -> DataFrame:
    """ord and the text of each article as the relevance question puts it."""
    return df.select(
        "ord",
        F.concat(F.lit("TITLE: "), "title", F.lit("\nSOURCE: "), "domain", F.lit("\nSNIPPET: "), "reasoning").alias("prompt"),
    )
