"""Counts and summaries. Every aggregate combines on the map side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank


def stage_counts(meta: DataFrame, stages: list[str]) -> DataFrame:
    return meta.agg(
        F.count("*").alias("n_rows"), *[F.count_if(F.col(s).isNotNull()).alias(f"n_{s}") for s in stages]
    )


def object_count(listing: DataFrame, prefix: str = "") -> DataFrame:
    """Objects under a prefix, nested below it and directly in it."""
    rest = F.substring(F.col("path"), F.lit(len(prefix) + 1), F.length("path"))
    nested = F.contains(rest, F.lit("/"))
    return listing.filter(F.col("path").startswith(prefix)).agg(
        F.count("*").alias("n_objects"),
        F.count_if(nested).alias("n_nested"),
        F.count_if(~nested).alias("n_top_level"),
    )


def run_summary(results: DataFrame) -> DataFrame:
    """Per status: items, attempts and items with an error. Input ``status, attempts, error``."""
    return results.groupBy("status").agg(
        F.count("*").alias("n_items"),
        F.sum("attempts").cast("long").alias("n_attempts"),
        F.count("error").alias("n_errors"),
    )


def run_errors(results: DataFrame, key: str = "doc_id") -> DataFrame:
    return results.filter(F.col("error").isNotNull()).select(key, "attempts", "error")


def progress_summary(items: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Distinct items, candidates and valid done ones, what is pending, and the share that is done."""
    a = items.select(F.trim(F.col(key).cast("string")).alias(key)).distinct().withColumn("_a", F.lit(1))
    b = done.select(F.trim(F.col(key).cast("string")).alias(key)).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, key, "full_outer")
    counted = both.agg(
        F.count("_a").alias("n_total"),
        F.count("_b").alias("n_candidates"),
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_done"),
    )
    return counted.withColumn("n_pending", F.col("n_total") - F.col("n_done")).withColumn(
        "ratio", F.col("n_done") / F.greatest(F.lit(1), F.col("n_total"))
    )


def document_rollup(chunks: DataFrame) -> DataFrame:
    """Chunks kept, seen and dropped per document, with its artefact id."""
    kept = ~is_blank(F.col("text"))
    return chunks.groupBy("doc_id").agg(
        F.count_if(kept).alias("chunk_count"),
        F.count("*").alias("original_chunk_count"),
        F.count_if(~kept).alias("dropped_empty_text_count"),
        F.max("artifact_uuid").alias("artifact_uuid"),
    )


def distinct_issue_names(findings: DataFrame) -> DataFrame:
    """Names found in each file, each once, in the order they first appear.

    Input ``doc_id, pos, name``. Repeats are combined before the names of a file meet.
    """
    firsts = findings.groupBy("doc_id", "name").agg(F.min("pos").alias("_at"))
    names = F.sort_array(F.collect_list(F.struct("_at", "name")))
    return firsts.groupBy("doc_id").agg(
        F.array_join(F.transform(names, lambda r: r["name"]), ", ").alias("names")
    )
