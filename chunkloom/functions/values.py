"""Vectors, JSON values, numbers and digests."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


@F.pandas_udf(T.StringType())
def canonical_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Sorted keys, ``", "`` and ``": "`` separators, non-ASCII kept; null for invalid JSON."""

    def one(text):
        try:
            return json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True)
        except (TypeError, ValueError):
            return None

    for texts in batches:
        yield texts.map(one)


def canonical_json_hash(text: Column) -> Column:
    return sha256(canonical_json(text))


def json_first(obj: Column, *keys: str) -> Column:
    """Value of the first key whose value is neither missing, null, false, zero nor empty."""
    parsed = F.try_parse_json(obj)
    candidates = []
    for key in keys:
        value = F.try_variant_get(parsed, f"$.{key}", "variant")
        kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
        text = F.get_json_object(obj, f"$.{key}")
        empty = (
            F.when(kind == "VOID", F.lit(True))
            .when(kind == "STRING", text == "")
            .when(kind == "BOOLEAN", text == "false")
            .when(kind.startswith("ARRAY"), text == "[]")
            .when(kind.startswith("OBJECT"), text == "{}")
            .otherwise(F.coalesce(text.try_cast("double"), F.lit(1.0)) == 0)
        )
        candidates.append(F.when(~empty, text))
    return F.coalesce(*candidates)


def l2_truncate(vector: Column, dims: int) -> Column:
    """First ``dims`` values divided by their norm; null when the vector is too short."""
    head = F.transform(F.slice(vector, 1, dims), lambda v: v.cast("double"))
    norm = F.sqrt(F.aggregate(head, F.lit(0.0), lambda a, v: a + v * v))
    scaled = F.transform(head, lambda v: F.when(norm == 0, v).otherwise(v / norm))
    return F.when(F.size(vector) >= dims, scaled)


def l2_error(vector: Column, dims: int) -> Column:
    size = F.coalesce(F.size(vector), F.lit(0))
    return F.when(
        size < dims,
        F.concat(
            F.lit("EMBEDDING_DIMENSION_TOO_SMALL: got "), size.cast("string"), F.lit(f", need {dims}")
        ),
    )


def chunk_text(item: Column) -> Column:
    """``struct(text, error)`` of a chunk held as JSON text."""
    parsed = F.try_parse_json(item)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    value = F.try_variant_get(parsed, "$.text", "variant")
    kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
    text = (
        F.when(kind == "VOID", F.lit(""))
        .when(kind == "STRING", F.try_variant_get(parsed, "$.text", "string"))
        .otherwise(canonical_json(F.to_json(value)))
    )
    error = F.when(~is_object, F.lit("EMBEDDING_CHUNK_NOT_OBJECT"))
    return F.struct(F.when(is_object, text).alias("text"), error.alias("error"))


def int_or_null(value: Column) -> Column:
    """Empty, null, zero and unreadable values become null."""
    return F.nullif(F.nullif(value.cast("string"), F.lit("")).try_cast("int"), F.lit(0))


def authors(additional: Column, fallback: Column) -> Column:
    """First column unless it is null, the word None or an empty list."""
    return F.when(additional.isNull() | additional.isin("None", "[]"), fallback).otherwise(additional)
