"""Queries that call a service for each batch of rows, with deterministic clients."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..operators import enrich, merging
from ..plans import domains
from ..session import shared_dir
from ..sinks import records
from .registry import CHUNKS, conversation_chunks, query, table


def _shape_embedder():
    """Length, spaces and one, answered in reverse order."""

    def call(texts):
        return [{"index": i, "embedding": [len(t), t.count(" "), 1, 99]} for i, t in enumerate(texts)][::-1]

    return call


@query(
    f"""WITH {CHUNKS}, k AS (SELECT doc_id, pos, CAST(len(text) AS DOUBLE) AS a,
    CAST(len(text) - len(replace(replace(text, chr(10), ' '), ' ', '')) AS DOUBLE) AS b FROM c)
SELECT doc_id, pos, round(a / sqrt(a * a + b * b + 1), 6) AS x, round(b / sqrt(a * a + b * b + 1), 6) AS y,
  round(1 / sqrt(a * a + b * b + 1), 6) AS z, NULL::VARCHAR AS error FROM k"""
)
def embed_chunks(spark, sf):
    done = enrich.embed_chunks(conversation_chunks(spark, sf), _shape_embedder, dims=3, batch=32)
    v = F.col("embedding")
    return done.select(
        "doc_id", "pos", F.round(v[0], 6).alias("x"), F.round(v[1], 6).alias("y"), F.round(v[2], 6).alias("z"), "error"
    )


@query(
    f"""WITH {CHUNKS}, d AS (SELECT DISTINCT replace(replace(text, chr(10) || chr(10), ' '), chr(10), ' ') AS asked FROM c)
SELECT 'asked' AS what, count(*) AS n FROM d UNION ALL SELECT 'asked again', 0 UNION ALL SELECT 'answered', (SELECT count(*) FROM c)
UNION ALL SELECT 'values', (SELECT CAST(sum(len(text) + len(text) - len(replace(replace(text, chr(10), ' '), ' ', ''))) AS BIGINT) FROM c)"""
)
def embed_chunks_once(spark, sf):
    """Each different text is asked for once, though its rows come twice and are embedded by two builds."""
    from ..operators import ledger

    folder = f"{shared_dir(spark)}/ledger-{uuid.uuid4().hex}"
    chunks = conversation_chunks(spark, sf)
    asked = tx.flatten_newlines(F.coalesce("text", F.lit("")))
    twice = chunks.unionByName(chunks).select(asked.alias("request"))
    vector = [T.StructField("embedding", T.ArrayType(T.DoubleType()))]

    def plain(reply, n):
        return [([float(x) for x in item["embedding"][:3]],) for item in sorted(reply, key=lambda r: r["index"])]

    counts = [ledger.ask(twice, folder, _shape_embedder, plain, vector, 32) for _ in range(2)]
    done = ledger.answered_rows(chunks.withColumn("_asked", asked), "_asked", folder, vector).where("error is null")
    total = done.agg(F.count("*").alias("n"), F.sum(F.col("embedding")[0] + F.col("embedding")[1]).cast("long").alias("v"))
    named = F.explode(F.array(*[F.struct(F.lit(w).alias("what"), x.alias("n")) for w, x in (
        ("asked", F.lit(counts[0])), ("asked again", F.lit(counts[1])), ("answered", F.col("n")), ("values", F.col("v")),
    )]))
    return total.select(named.alias("r")).select("r.what", F.col("r.n").cast("long").alias("n"))


def _line_parser():
    """One chunk per line and an empty one; texts without a line break lack the full text."""

    def call(requests):
        text = bytes(requests[0]).decode()
        reply = {"result": [{"text": x, "page_number": 1} for x in text.split("\n")] + [{"text": " "}, {}, 7, None]}
        return reply | ({"txt": text} if "\n" in text else {})

    return call


@query(
    """WITH k AS (SELECT doc_id, text, len(string_split(text, chr(10))) AS n, contains(text, chr(10)) AS ok FROM documents)
SELECT doc_id, CASE WHEN ok THEN len(text) END AS txt_chars, CASE WHEN ok THEN n + 4 END AS original,
  CASE WHEN ok THEN 2 END AS dropped, CASE WHEN NOT ok THEN 'parser response missing txt' END AS error FROM k"""
)
def parse_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    done = enrich.parse_documents(docs, _line_parser)
    return done.select(
        "doc_id",
        F.length("txt").cast("long").alias("txt_chars"),
        F.col("original_chunk_count").cast("long").alias("original"),
        F.col("dropped_empty_text_count").alias("dropped"),
        "error",
    )


def _captioner():
    return lambda paths: [f"a picture of {p}" for p in paths]


@query(
    """SELECT p_partkey, CASE WHEN p_type = 'SMALL' AND p_size > 25 THEN 'a picture of ' || p_brand ELSE p_name END AS text
FROM part"""
)
def describe_images(spark, sf):
    """Small parts are images, the bigger ones of them large enough to describe."""
    elements = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_type") == "SMALL", F.lit("Image")).otherwise(F.lit("Text")).alias("category"),
        F.col("p_name").alias("text"),
        (F.col("p_size") > 25).alias("large"),
        F.col("p_brand").alias("image_path"),
    )
    return enrich.describe_images(elements, _captioner, batch=50).select("p_partkey", "text")


def _examiner():
    def call(texts):
        kind = enrich.QA_CATEGORIES
        return [{"Question": "What is " + t[:20] + "?", "Answer": t[-20:], "Category": kind[len(t) % 3]} for t in texts]

    return call


@query(
    f"""WITH {CHUNKS}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM c),
g AS (SELECT doc_id, i // 2 AS grp, string_agg(text, ' ' ORDER BY pos) AS text FROM k GROUP BY ALL HAVING count(*) = 2)
SELECT doc_id, grp, 'What is ' || left(text, 20) || '?' AS question, right(text, 20) AS answer,
  ['环境工程学', '大气环境学', '水环境学'][len(text) % 3 + 1] AS category FROM g"""
)
def generate_qa(spark, sf):
    groups = merging.fixed_groups(conversation_chunks(spark, sf), 2)
    done = enrich.generate_qa(groups, _examiner, batch=10)
    return done.select("doc_id", "grp", "question", "answer", "category")


def _librarian():
    return lambda texts: [{"result": [{"Title": t[:30], "Year": str(1900 + len(t) % 100)}]} for t in texts]


@query("SELECT doc_id, left(text, 30) AS title, CAST(1900 + len(text) % 100 AS INTEGER) AS year FROM documents")
def extract_bibliography(spark, sf):
    """Bibliographies asked for and read from the replies."""
    from ..functions.values import int_or_null
    from ..sources.readers import rows_of_results

    docs = table(spark, sf, "documents").select("doc_id", "text")
    replies = enrich.extract_bibliography(docs, _librarian, batch=20)
    files = replies.select(F.col("doc_id").cast("string").alias("path"), F.col("response").alias("value"))
    rows = rows_of_results(files)
    return rows.select(
        F.col("filename_prefix").cast("long").alias("doc_id"),
        F.get_json_object("row", "$.Title").alias("title"),
        int_or_null(F.get_json_object("row", "$.Year")).alias("year"),
    )


def _editor():
    return lambda texts: [{"result": t.replace("\n", " / ")} for t in texts]


@query("SELECT doc_id, replace(text, chr(10), ' / ') AS text FROM documents")
def reformat_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return enrich.reformat_text(docs, _editor, batch=20).select("doc_id", "text")


@query(
    f"""WITH {CHUNKS}, l AS (SELECT doc_id, pos, '{{"page_number": ' || page_number || ', "text": ' || to_json(text) || '}}'
    || chr(10) AS line FROM c WHERE title <> 'system'),
f AS (SELECT doc_id, string_agg(line, '' ORDER BY pos) AS content, count(*) AS chunk_count FROM l GROUP BY doc_id)
SELECT doc_id, 'chunks_jsonl' AS role, 'u' || doc_id || '.jsonl' AS name, strlen(content) AS size,
  sha256(content) AS sha256, chunk_count, lang FROM f JOIN documents USING (doc_id)"""
)
def domain_knowledge_base(spark, sf):
    """Artefacts and manifests of parsed documents; the turns of the system are blank."""
    text = F.when(F.col("title") != "system", F.col("text"))
    chunks = conversation_chunks(spark, sf).select("doc_id", "pos", text.alias("text"), "page_number")
    docs = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("artifact_uuid"), "lang"
    )
    _, _, manifests, _, _ = domains.build_knowledge_base(chunks, docs, _shape_embedder, dims=3)
    entries = records.manifest_entries(manifests)
    return entries.join(manifests.select("doc_id", "chunk_count", "lang"), "doc_id")


@query(
    """WITH k AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_type || ' ' || p_name AS abstract, p_brand AS country FROM part
  WHERE p_size >= 10),
v AS (SELECT *, CAST(len(abstract) AS DOUBLE) AS a, CAST(len(abstract) - len(replace(abstract, ' ', '')) AS DOUBLE) AS b FROM k)
SELECT 'patent' AS namespace, id, abstract, country, round(a / sqrt(a * a + b * b + 1), 5) AS first_value FROM v"""
)
def domain_patent_vectors(spark, sf):
    """One vector per complete patent."""
    patents = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("publication_number"),
        F.when(F.col("p_size") < 10, F.lit("")).otherwise(F.col("p_name")).alias("title"),
        F.concat_ws(" ", "p_type", "p_name").alias("abstract"),
        F.col("p_name").alias("url"),
        F.col("p_brand").alias("country"),
        F.lit("20200101").alias("publication_date"),
    )
    _, found = domains.build_patent_index(patents, _shape_embedder, dims=3)
    first = F.round(F.element_at("values", 1).cast("double"), 5).alias("first_value")
    return found.select("namespace", "id", F.col("metadata.abstract").alias("abstract"), F.col("metadata.country").alias("country"), first)
