"""Rows for the indexes and artefacts downstream systems read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merging import number_rows
from ..schemas import INDEXES, enforce


def json_text(df: DataFrame, names: list[str]) -> Column:
    """One JSON object per row: given key order, ``", "`` and ``": "`` separators, nulls written."""
    parts = []
    for name in names:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            quoted = F.to_json(F.array(name))
            value = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
        elif isinstance(kind, (T.NumericType, T.BooleanType)):
            value = F.col(name).cast("string")
        else:
            value = F.to_json(F.col(name))
        value = F.when(F.col(name).isNull(), F.lit("null")).otherwise(value)
        parts.append(F.concat(F.lit(f'"{name}": '), value))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def chunk_jsonl(chunks: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """``doc_id, pos, line``: one JSON line per chunk, sorted keys, vectors left out."""
    names = payload or [c for c in chunks.columns if c not in ("doc_id", "pos", "sub", "idx", "chunk_id")]
    names = sorted(n for n in names if n != "embedding")
    return chunks.select("doc_id", "pos", json_text(chunks, names).alias("line"))


def fulltext_actions(
    chunks: DataFrame, index: str, fields: list[str], id_column: str = "chunk_id", slice_entries: int = 500
) -> DataFrame:
    """``index, id, action, source, bulk``: header and source lines; ``bulk`` numbers the requests of a
    document, each with half as many chunks as it has entries."""
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index"), F.col(id_column).alias("_id")).alias("index")))
    source = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    bulk = F.floor(F.col("idx") / (slice_entries // 2)) if "idx" in chunks.columns else F.lit(None).cast("long")
    return chunks.select(
        F.lit(index).alias("index"),
        F.col(id_column).alias("id"),
        action.alias("action"),
        source.alias("source"),
        bulk.alias("bulk"),
    )


def vector_records(
    chunks: DataFrame, namespace: str, fields: list[str], id_column: str = "chunk_id"
) -> DataFrame:
    """``id, values, metadata, namespace``; rows without a vector are left out."""
    return chunks.filter(F.col("embedding").isNotNull()).select(
        F.col(id_column).alias("id"),
        F.col("embedding").cast("array<float>").alias("values"),
        F.struct(*fields).alias("metadata"),
        F.lit(namespace).alias("namespace"),
    )


def text_objects(chunks: DataFrame, source: Column, with_page: bool = False) -> DataFrame:
    page = ["page_number"] if with_page else []
    return chunks.select("title", "content", source.alias("source"), *page)


def flat_vector_rows(chunks: DataFrame, longest: int | None = None) -> DataFrame:
    """``report_id, sort_number, vector, text`` numbered from zero per document."""
    numbered = number_rows(chunks, "doc_id", "pos", "sort_number", longest=longest)
    return numbered.select(
        F.col("doc_id").alias("report_id"), "sort_number", F.col("embedding").alias("vector"), "text"
    )


# The artefacts a document can have.
ROLES = ["chunks_jsonl", "chunks_pkl", "full_text_txt"]


def build_manifest(
    entries: DataFrame,
    docs: DataFrame,
    parser_profile: str,
    parser_version: str,
    embedding: dict | None = None,
    roles: list[str] = ROLES,
    producer: str = "chunkloom",
) -> DataFrame:
    """One manifest per document with maps of names, sizes and digests keyed by role.

    The usual roles are a fixed list, so each is a plain aggregate that combines before the shuffle; other
    roles (further parts of a file) follow in order. Repeats of a role keep the greatest name.
    """
    entry = F.struct("name", "size", "sha256")
    further = F.when(~F.col("role").isin(roles), F.struct(F.col("role").alias("k"), entry.alias("v")))
    per_role = entries.groupBy("doc_id").agg(
        *[
            F.max(F.when(F.col("role") == r, entry)).alias(f"_r{i}")
            for i, r in enumerate(roles)
        ],
        F.sort_array(F.collect_set(further)).alias("_further"),
    )
    last = F.expr("filter(_further, (e, i) -> i = size(_further) - 1 or _further[i + 1].k != e.k)")

    def by_role(field: str) -> Column:
        pairs = F.array(
            *[F.struct(F.lit(r).alias("k"), F.col(f"_r{i}.{field}").alias("v")) for i, r in enumerate(roles)]
        )
        more = F.transform(last, lambda e: F.struct(e["k"].alias("k"), e["v"][field].alias("v")))
        return F.map_from_entries(F.filter(F.concat(pairs, more), lambda p: p["v"].isNotNull()))

    manifest = docs.join(per_role, "doc_id").select(
        *docs.columns,
        by_role("name").alias("artifacts"),
        by_role("size").alias("size_bytes"),
        by_role("sha256").alias("sha256"),
        F.lit(producer).alias("producer"),
        F.lit(parser_profile).alias("parser_profile"),
        F.lit(parser_version).alias("parser_version"),
    )
    if embedding is not None:
        manifest = manifest.withColumn(
            "embedding",
            F.struct(
                F.lit(embedding["model"]).alias("model"), F.lit(embedding["dimensions"]).alias("dimensions")
            ),
        )
    return manifest


def manifest_json(manifest: DataFrame) -> DataFrame:
    """``doc_id`` and the manifest as JSON with sorted keys."""
    names = sorted(c for c in manifest.columns if c != "doc_id")
    return manifest.select("doc_id", F.to_json(F.struct(*names)).alias("manifest"))


def manifest_entries(manifests: DataFrame) -> DataFrame:
    """``doc_id, role, name, size, sha256`` of every artefact in the manifests."""
    return manifests.select("doc_id", F.explode("artifacts").alias("role", "name"), "size_bytes", "sha256").select(
        "doc_id",
        "role",
        "name",
        F.try_element_at("size_bytes", F.col("role")).alias("size"),
        F.try_element_at("sha256", F.col("role")).alias("sha256"),
    )


def chat_jsonl(sections: DataFrame, system: str) -> DataFrame:
    """Heading as the user's turn, body as the assistant's, under one fixed system message."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = F.array(
        turn("system", F.lit(system)), turn("user", F.col("heading")), turn("assistant", F.col("body"))
    )
    return sections.select("doc_id", "pos", F.to_json(F.struct(messages.alias("messages"))).alias("line"))


def submission_records(rows: DataFrame, docs: DataFrame, cap: int = 30 * 1024 * 1024) -> DataFrame:
    """Report records with the file as base64; a missing or too large file leaves the payload null.

    ``docs``: path, content, looked up by ``pdf_path``.
    """
    files = docs.select(
        F.col("path").alias("pdf_path"),
        F.when(F.length("content") < cap, F.base64("content")).alias("base64_content"),
    )
    return rows.join(files, "pdf_path", "left").withColumn(
        "media_type", F.when(F.col("base64_content").isNotNull(), F.lit("application/octet-stream"))
    )


def index_rows(rows: DataFrame, index: str) -> DataFrame:
    """Rows cast to the registered schema of an index; the id column is kept beside it."""
    return enforce(rows, T.StructType([T.StructField("id", T.StringType()), *INDEXES[index].fields]))
