"""Queries on manifests, artefacts and jobs: an order is a document, its line items are artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, joins
from ..sinks import records
from .registry import CHUNKS, conversation_chunks, query, table

_NAME = "l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' || CAST(round(l_extendedprice * 100) AS BIGINT)"


def _entries(spark, sf):
    item = table(spark, sf, "lineitem")
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    name = F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber", price)
    return item.select(
        F.col("l_orderkey").alias("doc_id"),
        F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("role"),
        name.alias("name"),
        (F.col("l_quantity") * 100).cast("long").alias("size"),
        F.sha2(name, 256).alias("sha256"),
        "l_linestatus",
        "l_returnflag",
        "l_tax",
        "l_discount",
    )


def _listing(spark, sf):
    """Items without discount are missing, returned ones have another size, untaxed ones another digest."""
    return _entries(spark, sf).filter("l_discount > 0").select(
        "doc_id",
        "name",
        (F.col("size") + F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("size"),
        F.when(F.col("l_tax") == 0, F.lit("0")).otherwise(F.upper("sha256")).alias("sha256"),
    )


_CHECKED = f"""k AS (SELECT l_orderkey AS doc_id, 'r' || l_linenumber AS role, {_NAME} AS name,
    CAST(l_quantity * 100 AS BIGINT) AS size, l_discount, l_returnflag, l_tax FROM lineitem),
v AS (SELECT doc_id, role, name, CASE WHEN l_discount = 0 THEN 'LOCAL_ARTIFACT_MISSING: ' || name
    WHEN l_returnflag = 'R' THEN 'S3_ARTIFACT_MISMATCH: ' || name || ' size'
    WHEN {{strict}} AND l_tax = 0 THEN 'S3_ARTIFACT_MISMATCH: ' || name || ' sha256' END AS error FROM k)"""


@query(f"WITH {_CHECKED.format(strict='true')} SELECT doc_id, role, name, error FROM v")
def verify_entries(spark, sf):
    entries = _entries(spark, sf).select("doc_id", "role", "name", "size", "sha256")
    return joins.verify_entries(entries, _listing(spark, sf), strict=True).drop("size", "sha256")


@query(
    f"""WITH {_CHECKED.format(strict='true')} SELECT doc_id, count(*) AS n_entries, count(error) AS n_failed,
  arg_min(error, role || '/' || name) FILTER (error IS NOT NULL) AS error FROM v GROUP BY doc_id"""
)
def verify_artifacts(spark, sf):
    entries = _entries(spark, sf).select("doc_id", "role", "name", "size", "sha256")
    return joins.verify_artifacts(entries, _listing(spark, sf), strict=True)


_ROLE = "CASE l_returnflag WHEN 'A' THEN 'chunks_jsonl' WHEN 'N' THEN 'chunks_pkl' ELSE 'full_text_txt' END"


@query(
    f"""WITH k AS (SELECT l_orderkey AS doc_id, {_ROLE} AS role, {_NAME} AS name, CAST(l_quantity * 100 AS BIGINT) AS size,
    sha256({_NAME}) AS sha256 FROM lineitem),
m AS (SELECT doc_id, role, max(name) AS name, arg_max(size, name) AS size, max_by(sha256, name) AS sha256 FROM k GROUP BY ALL)
SELECT doc_id, role, name, size, sha256 FROM m JOIN orders ON o_orderkey = doc_id"""
)
def build_manifest(spark, sf):
    """Manifests built per order, then taken apart again."""
    flag = F.col("l_returnflag")
    role = F.when(flag == "A", F.lit("chunks_jsonl")).when(flag == "N", F.lit("chunks_pkl")).otherwise("full_text_txt")
    entries = _entries(spark, sf).withColumn("role", role)
    docs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    manifest = records.build_manifest(entries, docs, "profile", "1", {"model": "m", "dimensions": 64})
    return records.manifest_entries(manifest)


def _manifests(spark, sf, remote=False):
    orders = table(spark, sf, "orders")
    version = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1)).otherwise(F.lit(2))
    artifact = F.col("o_custkey").cast("string")
    if remote:
        orders = orders.filter("o_orderstatus <> 'P'")
        version = F.when(F.col("o_orderpriority") == "2-HIGH", F.lit(9)).otherwise(version)
        artifact = F.when(F.col("o_orderpriority").isin("2-HIGH", "5-LOW"), F.lit("x")).otherwise(artifact)
    return orders.select(
        F.col("o_orderkey").alias("document_id"),
        version.alias("document_version"),
        artifact.alias("artifact_uuid"),
        F.col("o_orderpriority").alias("collection_path"),
    )


_COMPARED = """CASE WHEN o_orderstatus = 'P' THEN 'S3_MANIFEST_MISSING'
  WHEN o_orderpriority = '2-HIGH' THEN 'S3_MANIFEST_MISMATCH: document_version'
  WHEN o_orderpriority = '5-LOW' THEN 'S3_MANIFEST_MISMATCH: artifact_uuid' END"""


@query(f"SELECT o_orderkey AS document_id, {_COMPARED} AS error FROM orders")
def compare_manifests(spark, sf):
    return joins.compare_manifests(_manifests(spark, sf), _manifests(spark, sf, remote=True))


@query(
    f"""WITH {_CHECKED.format(strict='false')},
f AS (SELECT doc_id, arg_min(error, role || '/' || name) FILTER (error IS NOT NULL) AS file_error FROM v GROUP BY doc_id),
j AS (SELECT o_orderkey AS document_id, coalesce({_COMPARED}, file_error) AS e, o_totalprice > 400000 AS late
  FROM orders LEFT JOIN f ON doc_id = o_orderkey),
y AS (SELECT *, contains(e, 'S3_MANIFEST_MISMATCH') OR (contains(e, 'S3_ARTIFACT_MISMATCH') AND contains(e, 'sha256')) AS final FROM j)
SELECT document_id, CASE WHEN e IS NULL THEN 'ready' WHEN final OR late THEN 'failed' ELSE 'waiting' END AS state,
  CASE WHEN e IS NOT NULL AND late AND NOT final THEN 'S3_NOT_READY_AFTER_TIMEOUT: ' || e ELSE e END AS error FROM y"""
)
def ready_when_published(spark, sf):
    from ..streaming.jobs import ready_when_published as ready

    late = table(spark, sf, "orders").select(F.col("o_orderkey").alias("document_id"), "o_totalprice")
    local = _manifests(spark, sf).join(late, "document_id")
    entries = _entries(spark, sf).select("doc_id", "role", "name", "size", "sha256")
    return ready(local, _manifests(spark, sf, True), entries, _listing(spark, sf), F.col("o_totalprice") > 400000)


def _status(column):
    return F.when(column == "F", F.lit("failed")).when(column == "P", F.lit("running")).otherwise("done")


def _control_tables(spark, sf):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    jobs = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("job_id"),
        F.col("o_custkey").alias("document_id"),
        F.when(urgent, F.lit(1)).otherwise(F.lit(2)).alias("document_version"),
        F.lit("parse").alias("stage"),
        _status(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_orderdate")).alias("locked_until"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("created_at"),
    )
    segment = F.col("c_mktsegment")
    docs = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("document_id"),
        F.when(segment == "HOUSEHOLD", F.lit(1)).otherwise(F.lit(2)).alias("version"),
        F.col("c_nationkey").alias("collection_id"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("nas://raw/"), "c_name")).alias("raw_uri"),
        F.when(segment == "MACHINERY", F.lit("2024-01-01")).alias("deleted_at"),
        F.when(F.col("c_acctbal") > 9000, F.lit("m")).alias("processed_manifest_local_uri"),
        F.lit(None).cast("string").alias("processed_artifact_uuid"),
    )
    path = F.concat(F.lit("/"), "n_name", F.lit("//r"), F.col("n_regionkey").cast("string"))
    collections = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("collection_id"), path.alias("collection_path")
    )
    return jobs, docs, collections


_CONTROL = """o AS (SELECT o_orderkey AS job_id, o_custkey AS document_id, o_orderstatus, o_orderdate, o_totalprice,
  c_acctbal, n_name || '/r' || n_regionkey AS storage, n_name || '_pickle/r' || n_regionkey || '_pickle' AS processed
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
WHERE c_mktsegment <> 'MACHINERY' AND (o_orderpriority = '1-URGENT') = (c_mktsegment = 'HOUSEHOLD'))"""


@query(
    f"""WITH {_CONTROL} SELECT job_id, document_id, storage AS collection_storage_path, processed AS processed_storage_path,
  CASE WHEN c_acctbal > 0 THEN NULL ELSE 'Document ' || document_id || ' has no raw_uri.' END AS error
FROM o WHERE o_orderstatus = 'P'"""
)
def job_snapshot(spark, sf):
    found = joins.job_snapshot(*_control_tables(spark, sf), "parse")
    return found.select("job_id", "document_id", "collection_storage_path", "processed_storage_path", "error")


_CANDIDATE = """(o_orderstatus = 'F' OR (o_orderstatus = 'P' AND (o_totalprice <= 100000
  OR o_orderdate < TIMESTAMP '1998-01-01'))) AND c_acctbal <= 9000"""


@query(
    f"""WITH {_CONTROL} SELECT job_id, document_id, storage AS collection_storage_path FROM o WHERE {_CANDIDATE}
ORDER BY o_orderdate, job_id LIMIT 25"""
)
def finalization_candidates(spark, sf):
    now = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    found = joins.finalization_candidates(*_control_tables(spark, sf), now, 25)
    return found.select("job_id", "document_id", "collection_storage_path")


@query(
    f"""WITH {_CONTROL}, {_CHECKED.format(strict='false')},
f AS (SELECT doc_id, arg_min(error, role || '/' || name) FILTER (error IS NOT NULL) AS file_error FROM v GROUP BY doc_id),
c AS (SELECT o.*, CASE WHEN c_acctbal < 0 THEN 'MANIFEST_MISMATCH: processed_storage_path' ELSE file_error END AS error
  FROM o LEFT JOIN f ON f.doc_id = o.document_id WHERE {_CANDIDATE} AND c_acctbal <= 5000)
SELECT job_id, document_id, error, CASE WHEN error IS NULL THEN
  '{{"collection_path":"/' || replace(storage, '/', '//') || '","collection_storage_path":"' || storage
  || '","processed_storage_path":"' || processed || '","manifest_s3_key":"processed/' || processed || '/' || document_id
  || '/manifest.json","s3_bucket":"bucket","s3_prefix":"processed/","trigger":"parse_finalization_replay"}}' END AS payload
FROM c"""
)
def replayable(spark, sf):
    """Manifests exist for low balances and disagree for negative ones."""
    jobs, docs, collections = _control_tables(spark, sf)
    now = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    candidates = joins.finalization_candidates(jobs, docs, collections, now)
    customer = table(spark, sf, "customer").filter("c_acctbal <= 5000")
    nation = table(spark, sf, "nation")
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.col("n_regionkey").cast("string")
    processed = F.concat("n_name", F.lit("_pickle/r"), region, F.lit("_pickle"))
    manifests = home.select(
        F.col("c_custkey").alias("document_id"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(1)).otherwise(F.lit(2)).alias("document_version"),
        F.concat(F.lit("/"), "n_name", F.lit("//r"), region).alias("collection_path"),
        F.concat("n_name", F.lit("/r"), region).alias("collection_storage_path"),
        F.when(F.col("c_acctbal") < 0, F.lit("other")).otherwise(processed).alias("processed_storage_path"),
        F.lit("u").alias("artifact_uuid"),
    )
    entries = _entries(spark, sf).select("doc_id", "role", "name", "size", "sha256")
    found = joins.replayable(candidates, manifests, entries, _listing(spark, sf), "bucket", "processed/")
    return found.select("job_id", "document_id", "error", "payload")


@query(
    """WITH k AS (SELECT d.doc_id, d.lang, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN lang = 'fr' THEN 'RAW_STORAGE_PATH_MISMATCH: expected coll/' || doc_id || '.pdf'
  WHEN lang = 'de' THEN 'document file extension is required for raw storage path'
  WHEN quality IS NULL THEN 'RAW_NOT_FOUND' WHEN toxic = 1 THEN 'RAW_SIZE_MISMATCH'
  WHEN quality = 0 THEN 'RAW_HASH_MISMATCH' END AS error FROM k"""
)
def validate_raw(spark, sf):
    docs = table(spark, sf, "documents")
    lang, doc = F.col("lang"), F.col("doc_id").cast("string")
    path = F.concat(F.when(lang == "fr", F.lit("other/")).otherwise(F.lit("coll/")), doc, F.lit(".pdf"))
    digest = F.sha2("text", 256)
    expected = docs.select(
        "doc_id",
        F.col("doc_id").alias("document_id"),
        path.alias("raw_path"),
        F.lit("coll").alias("collection_storage_path"),
        F.lit(None).cast("string").alias("file_ext"),
        F.when(lang == "de", F.lit("scan")).otherwise(F.lit("scan.pdf")).alias("original_filename"),
        F.col("n_chars").alias("file_size"),
        digest.alias("sha256"),
    )
    listing = docs.join(table(spark, sf, "labels"), "doc_id").select(
        path.alias("path"),
        (F.col("n_chars") + F.col("toxic")).alias("size"),
        F.when(F.col("quality") == 0, F.lit("0")).otherwise(F.upper(digest)).alias("sha256"),
    )
    return checks.validate_raw(expected, listing).select("doc_id", "error")


@query(
    f"""WITH {CHUNKS} SELECT doc_id, count(*) AS n_expected, count(*) FILTER (title <> 'system') AS n_written,
  CASE WHEN count(*) FILTER (title = 'system') > 0 THEN 'ARTIFACT_VALIDATE_FAILED: jsonl row count mismatch' END AS error
FROM c GROUP BY doc_id"""
)
def validate_artifact(spark, sf):
    """The lines of the system's turns were lost on the way."""
    chunks = conversation_chunks(spark, sf)
    lines = records.chunk_jsonl(chunks.filter("title <> 'system'"))
    return checks.validate_artifact(chunks, lines)
