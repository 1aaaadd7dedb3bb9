"""Sorts, limits and set operations on work lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import year_month


def oldest_first(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The ``n`` oldest rows; a bounded heap per task, no global sort."""
    if n <= 0:
        raise ValueError("limit must be positive")
    return df.orderBy(*(order or ("updated_at", "created_at"))).limit(n)


def newest_issue_first(df: DataFrame, month: str = "date", tie: str = "doc_id") -> DataFrame:
    return df.withColumn("issue_date", year_month(F.col(month))).orderBy(F.desc("issue_date"), tie)


def abnormal_first(results: DataFrame, issues: str = "issues", tie: str = "path") -> DataFrame:
    return results.orderBy((F.size(issues) == 0).asc(), tie)


def restore_response_order(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Each request ``batch, slot, ...`` with the response ``batch, index, ...`` that answers it.

    A response without an index answers the first request of its batch. Requests without a response stay, with nulls;
    responses that answer no request are left out.
    """
    answers = responses.withColumn("slot", F.coalesce("index", F.lit(0)).cast(requests.schema["slot"].dataType))
    return requests.join(answers.drop("index"), ["batch", "slot"], "left")


def sample(df: DataFrame, n: int = 100, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.trim(F.col(key).cast("string")).alias(key))


def union_distinct_ids(parts: list[DataFrame], key: str = "doc_id") -> DataFrame:
    """Ids of all parts as trimmed strings, each once; duplicates go before the shuffle where they can."""
    return reduce(lambda a, b: a.unionByName(b), [_ids(p, key) for p in parts]).distinct()


def except_ids(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    return _ids(a, key).distinct().join(_ids(b, key), key, "left_anti")


def intersect_ids(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    return _ids(a, key).intersect(_ids(b, key))


def union_ragged(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def priority_order(items: DataFrame, urgent: Column, *order: str) -> DataFrame:
    """Urgent items before normal ones."""
    return items.withColumn("priority", F.when(urgent, F.lit(0)).otherwise(F.lit(1))).orderBy(
        "priority", *order
    )
