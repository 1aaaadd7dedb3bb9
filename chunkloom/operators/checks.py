"""Validation of raw files, artefacts and documents before they are processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..functions.text import strip


def validate_raw(docs: DataFrame, listing: DataFrame) -> DataFrame:
    """Add ``error``: first of path mismatch, missing file, size and hash differences.

    ``docs``: raw_path, collection_storage_path, document_id, file_ext, original_filename, file_size,
    sha256. ``listing``: path, size, sha256.
    """
    expected = paths.raw_storage_path(
        F.col("collection_storage_path"), F.col("document_id"), F.col("file_ext"), F.col("original_filename")
    )
    there = listing.select(F.col("path").alias("_p"), F.col("size").alias("_size"), F.col("sha256").alias("_sha"))
    joined = docs.withColumn("_want", expected).join(there, F.col("raw_path") == F.col("_p"), "left")
    error = (
        F.when(F.col("_want.error").isNotNull(), F.col("_want.error"))
        .when(
            F.col("raw_path") != F.col("_want.path"),
            F.concat(F.lit("RAW_STORAGE_PATH_MISMATCH: expected "), F.col("_want.path")),
        )
        .when(F.col("_p").isNull(), F.lit("RAW_NOT_FOUND"))
        .when(F.col("file_size") != F.col("_size"), F.lit("RAW_SIZE_MISMATCH"))
        .when(F.lower("sha256") != F.lower("_sha"), F.lit("RAW_HASH_MISMATCH"))
    )
    return joined.select(*docs.columns, error.alias("error"))


def validate_artifact(chunks: DataFrame, written: DataFrame) -> DataFrame:
    """Compare what was to be written with what can be read back: ``doc_id, n_expected, n_written, error``.

    ``written`` has one row ``doc_id, line`` per line read.
    """
    expected = chunks.groupBy("doc_id").agg(F.count("*").alias("n_expected"))
    found = written.groupBy("doc_id").agg(
        F.count("line").alias("n_written"), F.sum(F.octet_length("line")).alias("_bytes")
    )
    joined = expected.join(found, "doc_id", "full_outer").select(
        "doc_id",
        F.coalesce("n_expected", F.lit(0)).alias("n_expected"),
        F.coalesce("n_written", F.lit(0)).alias("n_written"),
        "_bytes",
    )
    error = (
        F.when(F.col("n_expected") == 0, F.lit("EMPTY_RESULT"))
        .when(
            F.col("n_expected") != F.col("n_written"),
            F.lit("ARTIFACT_VALIDATE_FAILED: jsonl row count mismatch"),
        )
        .when(F.coalesce("_bytes", F.lit(0)) <= 0, F.lit("ARTIFACT_VALIDATE_FAILED: empty artifact file"))
    )
    return joined.select("doc_id", "n_expected", "n_written", error.alias("error"))


def prescreen(docs: DataFrame, content: str = "html") -> DataFrame:
    """Issues and notes per marked-up document: ``issues``, ``info`` (arrays) and ``size``.

    An empty document has that one issue; otherwise all rules are tried. Regular expressions run in the
    JVM on the whole text.
    """
    body = F.col(content)
    size = F.coalesce(F.octet_length(content), F.lit(0))
    lowered = F.lower(body)
    opened = F.contains(lowered, F.lit("<html"))
    closed = F.contains(lowered, F.lit("</html>"))
    visible = strip(
        F.regexp_replace(
            F.regexp_replace(body, r"(?is)<(script|style|head)\b.*?</\1>|<!--.*?-->", ""), r"(?s)<[^>]*>", ""
        )
    )
    first = F.regexp_extract(lowered, r"(?s)<h1[^>]*>(.*?)</h1>", 1)
    rules: list[tuple[Column, str]] = [
        (~opened, "unreadable"),
        (~F.contains(lowered, F.lit("<body")), "no pages"),
        (F.length(visible) == 0, "no text on first page"),
        (opened & ~closed, "damaged structure"),
    ]
    found = F.array_compact(F.array(*[F.when(cond, F.lit(msg)) for cond, msg in rules]))
    notes = F.array_compact(
        F.array(
            F.when(F.length(first) > 0, F.lit("has heading")),
            F.when(F.contains(lowered, F.lit("<table")), F.lit("has table")),
        )
    )
    empty = size == 0
    return docs.withColumns(
        {
            "issues": F.when(empty, F.array(F.lit("zero bytes"))).otherwise(found),
            "info": F.when(empty, F.array().cast("array<string>")).otherwise(notes),
            "size": size.cast("long"),
        }
    )
