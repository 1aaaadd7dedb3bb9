"""Index builds per kind of source: merge, clean, number, attach metadata, embed, shape."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions import text as tx
from ..functions.tokens import Counter, token_estimate, truncate_words
from ..operators import enrich
from ..operators.filters import blank_to_null_dropna, drop_empty_chunks, drop_last_chunk
from ..operators.merging import HIGH, LOW, chunk_id, merge_small_chunks
from ..operators.segments import concat_ordered
from ..session import shared_dir
from ..sinks import records


def new_ledger(df: DataFrame) -> str:
    return f"{shared_dir(df.sparkSession)}/ledger-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Domain:
    """``meta`` maps each published field to an expression over the columns of the metadata table."""

    index: str
    namespace: str
    meta: dict[str, Callable[[], Column]]
    id_field: str = "rec_id"
    with_page: bool = False
    skip_last_chunk: bool = False
    vector_meta: dict[str, Callable[[], Column]] = field(default_factory=dict)

    @property
    def fields(self) -> list[str]:
        page = ["page_number"] if self.with_page else []
        return ["text", self.id_field, *page, *self.meta]


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _epoch(name: str) -> Callable[[], Column]:
    return lambda: dates.to_epoch(F.col(name))


def _parsed(name: str) -> Callable[[], Column]:
    return lambda: dates.to_unix_or_now(F.col(name), F.unix_timestamp())


def _names(name: str, sep: str) -> Callable[[], Column]:
    return lambda: tx.join_names(F.col(name), sep)


DOMAINS = {
    "esg": Domain(
        "esg",
        "esg",
        {
            "title": _col("report_title"),
            "country": _col("country"),
            "company_name": _col("company_name"),
            "publication_date": _epoch("publication_date"),
            "report_start_date": _epoch("report_start_date"),
            "report_end_date": _epoch("report_end_date"),
        },
        with_page=True,
    ),
    "education": Domain(
        "edu",
        "education",
        {"course": _col("course"), "name": _col("name"), "chapter_number": _col("chapter_number")},
    ),
    "textbooks": Domain(
        "textbooks",
        "textbook",
        {
            "title": _col("title"),
            "author": _names("authors", ", "),
            "isbn_number": _col("isbn_number"),
            "publication_date": _parsed("publish_time"),
        },
        with_page=True,
    ),
    "journals": Domain(
        "sci", "sci", {"journal": _col("journal"), "date": _parsed("date")}, id_field="doi"
    ),
    "reports": Domain(
        "reports",
        "report",
        {
            "title": _col("title"),
            "organization": _names("issuing_organization", "，"),
            "release_date": _epoch("release_date"),
            "url": _col("url"),
        },
        vector_meta={"organization": _names("issuing_organization", ". ")},
    ),
    "standards": Domain(
        "standards",
        "standard",
        {
            "title": _col("title"),
            "standard_number": _col("standard_number"),
            "organization": _names("issuing_organization", "，"),
            "effective_date": _epoch("effective_date"),
        },
    ),
    "internal": Domain(
        "internal_use",
        "internal_use",
        {"title": _col("title"), "tag": _col("tag")},
        skip_last_chunk=True,
    ),
}


def indexable_chunks(
    name: str,
    chunks: DataFrame,
    meta: DataFrame,
    lo: int = LOW,
    hi: int = HIGH,
    counter: Counter = token_estimate,
    longest: int | None = None,
) -> DataFrame:
    """Merged, cleaned and numbered chunks with the published metadata fields.

    Scan, numbering and metadata join share one shuffle of the chunks when ``longest`` shows that no
    document is cut into blocks.
    """
    domain = DOMAINS[name]
    if domain.skip_last_chunk:
        chunks = drop_last_chunk(chunks, longest)
    details = meta.select(
        "doc_id",
        *[make().alias(f) for f, make in domain.meta.items()],
        *[make().alias(f"_vector_{f}") for f, make in domain.vector_meta.items()],
    )
    merged = merge_small_chunks(chunks, lo, hi, counter, meta=details, longest=longest)
    return merged.withColumns(
        {
            "text": tx.fix_utf8(F.col("text")),
            "chunk_id": chunk_id(),
            domain.id_field: F.col("doc_id").cast("string"),
        }
    )


def build_index(
    name: str,
    chunks: DataFrame,
    meta: DataFrame,
    make_client: Callable | None = None,
    dims: int = 1536,
    batch: int = 1000,
    lo: int = LOW,
    hi: int = HIGH,
    counter: Counter = token_estimate,
    slice_entries: int = 500,
    longest: int | None = None,
    ledger: str | None = None,
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Full-text actions, vector records and failed chunks of one kind of source.

    Vectors are made only with a client. It is asked here, once for each different text that the ``ledger`` (a
    folder; a new one by default) has no answer to; all results are read from there.
    """
    domain = DOMAINS[name]
    ready = indexable_chunks(name, chunks, meta, lo, hi, counter, longest)
    fulltext = records.fulltext_actions(ready, domain.index, domain.fields, slice_entries=slice_entries)
    if make_client is None:
        return fulltext, None, None
    swapped = {f: F.col(f"_vector_{f}") for f in domain.vector_meta}
    embedded = enrich.embed_chunks(
        ready.withColumns(swapped), make_client, dims, batch, attempts=3, wait=2.0, ledger=ledger or new_ledger(chunks)
    )
    vectors = records.vector_records(embedded, domain.namespace, domain.fields)
    errors = embedded.filter(F.col("error").isNotNull()).select("doc_id", "chunk_id", "error")
    return fulltext, vectors, errors


PATENT_FIELDS = ["abstract", "title", "url", "country", "publication_date"]


def patent_rows(patents: DataFrame, limit: int = 8192, truncate: Callable = truncate_words) -> DataFrame:
    """Complete patents only, abstracts cut to the token limit of the embedding service."""
    complete = blank_to_null_dropna(patents)
    return complete.withColumn("abstract", truncate(F.col("abstract"), limit)).withColumn(
        "publication_date", F.col("publication_date").try_cast("long")
    )


def build_patent_index(
    patents: DataFrame,
    make_client: Callable | None = None,
    dims: int = 1536,
    batch: int = 1000,
    ledger: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """One row per patent, its id is the publication number; the ``ledger`` is that of ``build_index``."""
    complete = blank_to_null_dropna(patents).withColumn(
        "publication_date", F.col("publication_date").try_cast("long")
    )
    fulltext = records.fulltext_actions(complete, "patents", PATENT_FIELDS, "publication_number")
    if make_client is None:
        return fulltext, None
    asked = patent_rows(patents).withColumn("text", F.col("abstract"))
    embedded = enrich.embed_chunks(
        asked, make_client, dims, batch, attempts=10, wait=3.0, ledger=ledger or new_ledger(patents)
    )
    return fulltext, records.vector_records(embedded, "patent", PATENT_FIELDS, "publication_number")


def build_knowledge_base(
    chunks: DataFrame,
    docs: DataFrame,
    make_client: Callable,
    dims: int = 1536,
    batch: int = 32,
    parser_profile: str = "default",
    parser_version: str = "1",
    model: str = "default",
    part_chunks: int = 10_000,
    ledger: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """Artefacts of parsed documents: file parts, manifest entries, manifests, failed chunks and vectors.

    ``docs``: doc_id, artifact_uuid and the fields the manifest shows. Blank chunks are dropped, the
    others embedded and written as JSON lines without their vectors. A file holds the lines of
    ``part_chunks`` positions, so no document has to fit one task; documents that are not longer have
    one file, named after the artefact. A document with a failed chunk has no artefacts and no vectors.
    The service is asked here, once for each different text that the ``ledger`` (a folder; a new one by default) has
    no answer to; all results are derived from the stored answers.
    """
    kept = drop_empty_chunks(chunks)
    embedded = enrich.embed_chunks(kept, make_client, dims, batch, ledger=ledger or new_ledger(chunks))
    errors = embedded.filter(F.col("error").isNotNull()).select("doc_id", "pos", "error")
    embedded = embedded.join(errors.select("doc_id").distinct(), "doc_id", "left_anti").drop("error")
    vectors = embedded.select("doc_id", "pos", "embedding")
    lines = records.chunk_jsonl(embedded)
    lines = lines.withColumns(
        {"line": F.concat("line", F.lit("\n")), "part": F.expr(f"pos div {part_chunks}")}
    )
    files = lines.groupBy("doc_id", "part").agg(
        concat_ordered("line", ["pos"]).alias("content"), F.count("*").alias("n_lines")
    )
    named = files.join(docs.select("doc_id", "artifact_uuid"), "doc_id")
    suffix = F.when(F.col("part") == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.col("part").cast("string")))
    named = named.select(
        "doc_id",
        "part",
        F.concat(F.lit("chunks_jsonl"), suffix).alias("role"),
        F.concat("artifact_uuid", suffix, F.lit(".jsonl")).alias("name"),
        F.octet_length("content").cast("long").alias("size"),
        F.sha2("content", 256).alias("sha256"),
        "n_lines",
        "content",
    )
    entries = named.select("doc_id", "role", "name", "size", "sha256", "n_lines")
    counts = chunks.groupBy("doc_id").agg(F.count_if(~tx.is_blank(F.col("text"))).alias("chunk_count"))
    embedding = {"model": model, "dimensions": dims}
    manifests = records.build_manifest(
        entries, docs.join(counts, "doc_id"), parser_profile, parser_version, embedding
    )
    return named.select("doc_id", "part", "name", "content"), entries, manifests, errors, vectors
