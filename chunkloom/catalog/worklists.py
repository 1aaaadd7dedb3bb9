"""Queries on metadata and work lists: a labelled document counts as one that has its artefact."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates, filters, joins, sets, shards, vectors
from ..plans import domains
from ..plans.pending import PendingIndex
from ..session import shared_dir
from ..sinks import changes
from ..sources import pages, readers
from ..streaming import documents
from .registry import query, table


def _meta(spark, sf):
    labels = table(spark, sf, "labels")
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    return (
        table(spark, sf, "documents")
        .select("doc_id", "lang", "source", "n_chars")
        .join(labels, "doc_id", "left")
        .withColumn("parse_time", F.when(F.col("quality").isNotNull(), at))
        .withColumn("fulltext_time", F.when(F.col("quality") == 1, at))
    )


@query(
    """SELECT doc_id, lang FROM documents JOIN labels USING (doc_id) WHERE quality <> 1 OR quality IS NULL"""
)
def scan_pending(spark, sf):
    return readers.scan_pending(_meta(spark, sf), ["parse_time"], ["fulltext_time"]).select("doc_id", "lang")


@query("SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE lang = 'en' AND toxic = 0")
def filter_spec(spark, sf):
    spec = {"$all": [{"$exists": "quality"}, {"lang": "en"}, {"toxic": 0}]}
    return _meta(spark, sf).filter(filters.filter_spec(spec)).select("doc_id")


@query("SELECT d.doc_id, quality, toxic FROM documents d JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def complete_metadata(spark, sf):
    return filters.complete_metadata(_meta(spark, sf), ["quality", "toxic"]).select("doc_id", "quality", "toxic")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_only(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.pending_only(docs, table(spark, sf, "labels"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def present_in_both(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.present_in_both(docs, table(spark, sf, "labels"))


@query("SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def orphan_artifacts(spark, sf):
    """Only English documents are in the metadata table."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return joins.orphan_artifacts(labels, table(spark, sf, "documents").filter("lang = 'en'"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def exclude_blocklist(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return joins.exclude_blocklist(docs, table(spark, sf, "labels").filter("toxic = 1"))


_SIDES = """a AS (SELECT doc_id FROM documents WHERE lang = 'en'), b AS (SELECT doc_id FROM labels),
x AS (SELECT doc_id, 'only_a' AS side FROM a WHERE doc_id NOT IN (SELECT doc_id FROM b)
  UNION ALL SELECT doc_id, 'only_b' FROM b WHERE doc_id NOT IN (SELECT doc_id FROM a))"""


@query(f"WITH {_SIDES} SELECT doc_id, side FROM x")
def diff_inventories(spark, sf):
    english = table(spark, sf, "documents").filter("lang = 'en'")
    return joins.diff_inventories(english, table(spark, sf, "labels"))


@query(
    f"""WITH {_SIDES}, r AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY doc_id) AS i FROM x)
SELECT side, count(*) AS n, string_agg(CAST(doc_id AS VARCHAR), ' ' ORDER BY doc_id) FILTER (i <= 100) AS sample
FROM r GROUP BY side"""
)
def diff_summary(spark, sf):
    english = table(spark, sf, "documents").filter("lang = 'en'")
    found = joins.diff_summary(joins.diff_inventories(english, table(spark, sf, "labels")))
    return found.withColumn("sample", F.array_join("sample", " "))


@query(
    """SELECT count(*) AS n_rows, count(quality) AS n_parse_time,
  count(*) FILTER (quality = 1) AS n_fulltext_time FROM documents LEFT JOIN labels USING (doc_id)"""
)
def stage_counts(spark, sf):
    return aggregates.stage_counts(_meta(spark, sf), ["parse_time", "fulltext_time"])


@query(
    """WITH k AS (SELECT (SELECT count(DISTINCT doc_id) FROM documents WHERE lang = 'en') AS n_total,
  (SELECT count(DISTINCT doc_id) FROM labels) AS n_candidates,
  (SELECT count(*) FROM documents JOIN labels USING (doc_id) WHERE lang = 'en') AS n_done)
SELECT *, n_total - n_done AS n_pending, n_done / greatest(1, n_total) AS ratio FROM k"""
)
def progress_summary(spark, sf):
    english = table(spark, sf, "documents").filter("lang = 'en'")
    return aggregates.progress_summary(english, table(spark, sf, "labels"))


@query("SELECT DISTINCT trim(CAST(doc_id AS VARCHAR)) AS doc_id FROM (SELECT doc_id FROM documents UNION ALL SELECT doc_id FROM labels)")
def union_distinct_ids(spark, sf):
    padded = table(spark, sf, "labels").select(F.concat(F.lit(" "), F.col("doc_id").cast("string")).alias("doc_id"))
    return sets.union_distinct_ids([table(spark, sf, "documents"), padded])


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents EXCEPT SELECT CAST(doc_id AS VARCHAR) FROM labels")
def except_ids(spark, sf):
    return sets.except_ids(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id FROM documents INTERSECT SELECT CAST(doc_id AS VARCHAR) FROM labels")
def intersect_ids(spark, sf):
    return sets.intersect_ids(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query(
    """SELECT doc_id, lang, NULL::INTEGER AS quality FROM documents
UNION ALL SELECT doc_id, NULL, quality FROM labels"""
)
def union_ragged(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sets.union_ragged([docs, table(spark, sf, "labels").select("doc_id", "quality")])


def _jobs(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate")


_RANKED = """WITH k AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) - 1 AS i,
  count(*) OVER () AS n FROM orders)"""


@query(f"{_RANKED} SELECT o_orderkey, CAST(i % 4 AS INTEGER) AS shard FROM k")
def shard_round_robin(spark, sf):
    return shards.shard_round_robin(_jobs(spark, sf), 4, F.desc("o_orderdate"), F.asc("o_orderkey")).drop("o_orderdate")


@query(
    """SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS INTEGER) AS shard FROM orders"""
)
def shard_balanced(spark, sf):
    return shards.shard_balanced(_jobs(spark, sf), 7, "o_orderdate", "o_orderkey").drop("o_orderdate")


@query(f"{_RANKED} SELECT o_orderkey, CAST(least(i // (n // 7), 6) AS INTEGER) AS shard FROM k")
def shard_floor_tail(spark, sf):
    return shards.shard_floor_tail(_jobs(spark, sf), 7, F.desc("o_orderdate"), F.asc("o_orderkey")).drop("o_orderdate")


@query(f"{_RANKED} SELECT o_orderkey, CAST(i // CAST(ceil(n / 7) AS BIGINT) AS INTEGER) AS shard FROM k")
def shard_ceil(spark, sf):
    return shards.shard_ceil(_jobs(spark, sf), 7, F.desc("o_orderdate"), F.asc("o_orderkey")).drop("o_orderdate")


@query(f"{_RANKED} SELECT o_orderkey, i // 1000 AS batch FROM k")
def batch_ids(spark, sf):
    return shards.batch_ids(_jobs(spark, sf), 1000, F.desc("o_orderdate"), F.asc("o_orderkey")).drop("o_orderdate")


@query(
    """WITH k AS (SELECT trim(CAST(doc_id AS VARCHAR)) AS doc_id FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND lang <> 'de')
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 AS batch FROM k"""
)
def scan_work_batches(spark, sf):
    """German documents have a blank id; toxic ones are done; labelled ones have a file."""
    blank = F.when(F.col("lang") == "de", F.lit("  ")).otherwise(F.col("doc_id").cast("string"))
    items = table(spark, sf, "documents").select(blank.alias("doc_id"))
    labels = table(spark, sf, "labels")
    return readers.scan_work_batches(items, labels.filter("toxic = 1"), labels, 50)


@query("SELECT max(c_custkey) AS last_key, count(*) AS n_rows FROM customer")
def export_checkpoint(spark, sf):
    return readers.export_checkpoint(readers.export_incremental(table(spark, sf, "customer"), "c_custkey"), "c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey > (SELECT max(s_suppkey) FROM supplier)")
def export_incremental(spark, sf):
    """Customers after the last key of the suppliers, as if those had been exported before."""
    last = table(spark, sf, "supplier").agg(F.max("s_suppkey")).scalar()
    return readers.export_incremental(table(spark, sf, "customer"), "c_custkey", last).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def export_pages(spark, sf):
    """Customers exported page by page; stopped after the first batches and resumed from the last key."""
    folder, path = f"{shared_dir(spark)}/{uuid.uuid4().hex}", f"{sf}/customer.parquet"
    pages.plan_pages(table(spark, sf, "customer"), "c_custkey", f"{folder}/pages", 1000)

    def start(per_batch):
        rows = pages.stream_pages(spark, path, "c_custkey", f"{folder}/pages", ["c_custkey", "c_name", "c_acctbal"], per_batch)
        return pages.export_pages(rows, f"{folder}/out", f"{folder}/state")

    for per_batch in (1, 4):
        run = start(per_batch)
        while per_batch == 1 and run.isActive and not run.lastProgress:
            run.awaitTermination(0.2)
        if per_batch > 1:
            run.processAllAvailable()
        run.stop()
    return documents.current_rows(spark, f"{folder}/out").select("c_custkey", "c_name", "c_acctbal")


@query(
    """WITH k AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, length(text) AS size, coalesce(toxic, 0) = 1 AS bad,
  CASE WHEN doc_id % 2 = 1 OR doc_id % 10 = 0 THEN 3 ELSE 1 END AS version FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, version, CASE WHEN NOT bad THEN size END AS size, CASE WHEN bad THEN 'toxic' END AS error FROM k"""
)
def index_pending(spark, sf):
    """Half of the documents, then the others and some that changed, then no news; toxic ones fail."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    docs = table(spark, sf, "documents").select("doc_id", F.length("text").cast("long").alias("size"))
    docs = docs.join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "left")
    index = PendingIndex(f"{folder}/log", f"{folder}/index")

    def build(waiting):
        rows = waiting.select(F.col("doc_id").cast("long").alias("doc_id")).join(docs, "doc_id")
        return rows.withColumn("error", F.when(F.col("toxic") == 1, F.lit("toxic"))).drop("toxic")

    for day, some in enumerate(("doc_id % 2 = 0", "doc_id % 2 = 1 or doc_id % 10 = 0", None)):
        if some:
            at = F.lit(f"2024-01-0{day + 1}").cast("timestamp")
            changes.append_version(docs.where(some).select("doc_id", F.lit("upload").alias("stage"), at.alias("at")), f"{folder}/log")
        index.run(spark, build)
    rows = index.rows(spark).select("doc_id", "version", "size", F.lit(None).cast("string").alias("error"))
    failed = index.skipped(spark).select("doc_id", "version", F.lit(None).cast("long").alias("size"), "error")
    return rows.unionByName(failed)


@query("SELECT page_id, url FROM pages")
def scan_table(spark, sf):
    return readers.scan_table(spark, f"{sf}/pages.parquet", ["page_id", "url"])


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') || '-01' AS issue_date FROM orders"""
)
def newest_issue_first(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("date"))
    ordered = sets.newest_issue_first(orders, "date", "o_orderkey")
    return ordered.select("o_orderkey", F.col("issue_date").cast("string").alias("issue_date"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 25")
def oldest_first(spark, sf):
    return sets.oldest_first(table(spark, sf, "orders"), 25, "o_orderdate", "o_orderkey").select("o_orderkey")


@query(
    """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 100"""
)
def sample(spark, sf):
    missing = joins.pending_only(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"))
    return sets.sample(missing, 100, "doc_id")


@query("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 1 END AS priority FROM orders")
def priority_order(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sets.priority_order(orders, F.col("o_orderpriority") == "1-URGENT", "o_orderkey").drop("o_orderpriority")


@query(
    """SELECT doc_id, CASE lang WHEN 'en' THEN 'pdf' WHEN 'fr' THEN 'docx' WHEN 'de' THEN 'pptx' END AS handler
FROM documents"""
)
def route_by_type(spark, sf):
    lang = F.col("lang")
    kind = F.when(lang == "en", F.lit(".PDF")).when(lang == "fr", F.lit("doc")).when(lang == "de", F.lit("Pptx")).otherwise("txt")
    docs = table(spark, sf, "documents").select("doc_id", kind.alias("file_type"))
    return filters.route_by_type(docs).drop("file_type")


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'eng' ELSE lang || '+eng' END AS languages FROM documents")
def ocr_languages(spark, sf):
    lang = F.when(F.col("lang") == "en", F.lit("eng")).otherwise(F.col("lang"))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(filters.ocr_languages(lang), "+").alias("languages")
    )


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS publication_number, p_name AS title, p_type AS abstract, p_brand AS url
FROM part WHERE p_size >= 10 AND p_type <> 'SMALL'"""
)
def blank_to_null_dropna(spark, sf):
    patents = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("publication_number"),
        F.when(F.col("p_size") < 10, F.lit("")).otherwise(F.col("p_name")).alias("title"),
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("abstract"),
        F.col("p_brand").alias("url"),
    )
    return filters.blank_to_null_dropna(patents)


@query(
    """SELECT 'patents' AS "index", CAST(p_partkey AS VARCHAR) AS id,
  '{"index":{"_index":"patents","_id":"' || p_partkey || '"}}' AS action, NULL::BIGINT AS bulk,
  CAST(to_json({'abstract': p_type, 'title': p_name, 'url': p_brand, 'country': 'CN', 'publication_date': 19000000 + p_size})
    AS VARCHAR) AS source FROM part WHERE p_size >= 10"""
)
def domain_patents(spark, sf):
    patents = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("publication_number"),
        F.when(F.col("p_size") < 10, F.lit("")).otherwise(F.col("p_name")).alias("title"),
        F.col("p_type").alias("abstract"),
        F.col("p_brand").alias("url"),
        F.lit("CN").alias("country"),
        (F.col("p_size") + 19000000).cast("string").alias("publication_date"),
    )
    fulltext, _ = domains.build_patent_index(patents)
    return fulltext


@query(
    """WITH q AS (SELECT embedding AS v FROM embeddings ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(list_cosine_similarity(list_transform(embedding, lambda x: CAST(x AS DOUBLE)),
    list_transform((SELECT v FROM q), lambda x: CAST(x AS DOUBLE))), 6) AS similarity
FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 10"""
)
def top_k_similar(spark, sf):
    """Nearest neighbours of the first vector of the table."""
    embeddings = table(spark, sf, "embeddings")
    question = embeddings.orderBy("vec_id").select("embedding").first()[0]
    found = vectors.top_k_similar(embeddings, question, 10)
    return found.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(
    """WITH f AS (SELECT user_id, event_type, min(event_id) AS first_id FROM events GROUP BY ALL)
SELECT user_id AS doc_id, string_agg(event_type, ', ' ORDER BY first_id) AS names FROM f GROUP BY user_id"""
)
def distinct_issue_names(spark, sf):
    findings = table(spark, sf, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("name")
    )
    return aggregates.distinct_issue_names(findings)
