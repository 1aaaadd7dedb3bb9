"""Failure classes, retry rules and back-off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Failure messages that no retry can cure, whole and by prefix.
FINAL_PARSE_MESSAGES = ["RAW_HASH_MISMATCH", "EMPTY_RESULT", "EMBEDDING_CHUNK_NOT_OBJECT"]
FINAL_PARSE_PREFIXES = [
    "RAW_STORAGE_PATH_MISMATCH",
    "EMBEDDING_DIMENSION_TOO_SMALL",
    "parser response ",
    "parser result ",
    "embedding response ",
]

TIMEOUT = "timeout"
NETWORK = "network"
PARSER = "parser"
EMBEDDING = "embedding"


def _http_status(message: Column, service: str) -> Column:
    # The status is the text between the fixed prefix and the first colon, when it is a number.
    raw = F.regexp_extract(message, rf"^{service} http error ([^:]*)", 1)
    return F.trim(raw).try_cast("int")


def _retryable_status(status: Column) -> Column:
    return F.coalesce((status == 429) | (status >= 500), F.lit(False))


def retryable_parse(error_class: Column, message: Column) -> Column:
    """Error classes are ``timeout``, ``network``, ``parser``, ``embedding`` or anything else."""
    prefixed = F.lit(False)
    for prefix in FINAL_PARSE_PREFIXES:
        prefixed = prefixed | message.startswith(prefix)
    embedding_status = _http_status(message, "embedding")
    return (
        F.when(error_class.isin(TIMEOUT, NETWORK), F.lit(True))
        .when(message.isin(*FINAL_PARSE_MESSAGES), F.lit(False))
        .when(prefixed, F.lit(False))
        .when(error_class == PARSER, _retryable_status(_http_status(message, "parser")))
        .when(
            error_class == EMBEDDING,
            embedding_status.isNull() | _retryable_status(embedding_status),
        )
        .otherwise(F.lit(True))
    )


def retryable_ready(error_class: Column, message: Column) -> Column:
    lost_artifact = F.contains(message, F.lit("S3_ARTIFACT_MISMATCH")) & F.contains(message, F.lit("sha256"))
    return (
        F.when(error_class == TIMEOUT, F.lit(True))
        .when(message == "LOCAL_MANIFEST_MISSING", F.lit(False))
        .when(F.contains(message, F.lit("S3_MANIFEST_MISMATCH")), F.lit(False))
        .when(lost_artifact, F.lit(False))
        .otherwise(F.lit(True))
    )


def backoff(attempt: Column, initial: float = 1.0) -> Column:
    """Seconds to wait after an attempt, doubling from the first."""
    return F.lit(initial) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt - 1))
