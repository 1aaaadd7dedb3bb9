"""Table schemas, and the index schemas rows must match before they are published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
    "points": T.ArrayType(
        T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    ),
    "vector": T.ArrayType(T.FloatType()),
    "turns": T.ArrayType(
        T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
    ),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES = {
    "stage_log": _schema("doc_id string, stage string, at timestamp"),
    "elements": _schema(
        "doc_id string, pos bigint, category string, text string, page_number int, html string, "
        "points points"
    ),
    "chunks": _schema("doc_id string, pos bigint, title string, text string, page_number int"),
    "vector_records": _schema("id string, values vector, metadata string, namespace string"),
    "fulltext_actions": _schema("index string, id string, source string"),
    "text_objects": _schema("title string, content string, source string, page_number int"),
    "jobs": _schema(
        "job_id string, document_id string, document_version int, stage string, status string, "
        "locked_until timestamp, payload_json string, updated_at timestamp, created_at timestamp"
    ),
    "documents": _schema(
        "document_id string, version int, collection_id string, status string, raw_uri string, "
        "file_ext string, file_size bigint, sha256 string, original_filename string, metadata_json string, "
        "processed_manifest_local_uri string, processed_artifact_uuid string, chunk_count int, "
        "deleted_at timestamp"
    ),
    "collections": _schema("collection_id string, name string, collection_path string, content_type string"),
    "manifest_entries": _schema("doc_id string, role string, name string, size bigint, sha256 string"),
    "listing": _schema("path string, size bigint, modified timestamp"),
    "queue_messages": _schema("msg_id bigint, job_id string, payload string"),
    "patents": _schema(
        "publication_number string, title string, abstract string, url string, country string, "
        "publication_date string"
    ),
    "messages": _schema("messages turns"),
    "questions": _schema("question string, answer string, category string"),
}

# One entry per index: keyword and text fields are strings, epoch dates are whole seconds.
INDEXES = {
    "esg": _schema(
        "rec_id string, page_number string, text string, title string, company_name string, country string, "
        "publication_date bigint, report_start_date bigint, report_end_date bigint"
    ),
    "edu": _schema("text string, rec_id string, course string, name string, chapter_number string"),
    "textbooks": _schema(
        "rec_id string, text string, title string, author string, publication_date bigint, "
        "isbn_number string, page_number string"
    ),
    "sci": _schema("text string, doi string, journal string, date bigint"),
    "reports": _schema(
        "rec_id string, text string, title string, organization string, release_date bigint, url string"
    ),
    "standards": _schema(
        "rec_id string, text string, title string, organization string, effective_date bigint, "
        "standard_number string"
    ),
    "internal_use": _schema("text string, rec_id string, title string, tag string"),
    "patents": _schema(
        "abstract string, title string, country string, url string, publication_date bigint"
    ),
}


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order, cast and check the columns of a table against a schema; unknown columns are left out."""
    casts = {
        f.name: F.col(f.name).cast(f.dataType)
        for f in schema.fields
        if df.schema[f.name].dataType != f.dataType
    }
    return df.withColumns(casts).to(schema)
