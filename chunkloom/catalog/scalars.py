"""Queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, paths, status, tokens, values
from ..functions import text as tx
from .registry import ELEMENTS, document_elements, query, table
from .registry import tokens as token_sql


@query(
    f"""SELECT doc_id, {token_sql('text')} AS n_tokens, len(string_split(text, ' ')) AS n_words,
  {token_sql("replace(text, ' ', '')")} AS n_unspaced, array_to_string(string_split(text, ' ')[1:50], ' ') AS head FROM documents"""
)
def token_count(spark, sf):
    """The estimate is the same with and without spaces; words are counted by spaces."""
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        tokens.token_estimate(F.col("text")).cast("long").alias("n_tokens"),
        tokens.word_count(F.col("text")).cast("long").alias("n_words"),
        tokens.token_estimate(F.replace("text", F.lit(" "))).cast("long").alias("n_unspaced"),
        tokens.truncate_words(F.col("text"), 50).alias("head"),
    )


@query()
def bpe_token_count(spark, sf):
    """Exact counts by the ranks of a public vocabulary, and the first 50 tokens as text."""
    import public_tokenizers

    path, text = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), F.col("text")
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", tokens.bpe_counter(path)(text).alias("n_tokens"), tokens.bpe_truncate(path, 50)(text).alias("head")
    )


@query(
    """WITH k AS (SELECT page_id, url || '?q=a b+c*~%zz/é' AS key FROM pages),
o AS (SELECT *, replace(url_encode(key), '%2F', '/') AS once FROM k)
SELECT page_id, replace(url_encode(once), '%2F', '/') AS encoded, key AS decoded FROM o"""
)
def encode_key(spark, sf):
    key = F.concat("url", F.lit("?q=a b+c*~%zz/é"))
    pages = table(spark, sf, "pages").select("page_id", paths.encode_key(key).alias("encoded"))
    return pages.withColumn("decoded", paths.decode_key(F.col("encoded")))


@query(
    """WITH k AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages)
SELECT page_id, base, string_split(base, '.')[1] AS file_id, regexp_extract(base, '^.+(\\.[^.]+)$', 1) AS ext,
  substr(base, 1, len(base) - len(regexp_extract(base, '^.+(\\.[^.]+)$', 1))) AS stem,
  regexp_extract(url, '([^/]*)/[^/]*$', 1) AS parent,
  substr(url, 5, len(url) - 7) AS inner_part FROM k"""
)
def path_parts(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        paths.base_name(url).alias("base"),
        paths.file_id(paths.base_name(url)).alias("file_id"),
        paths.extension(url).alias("ext"),
        paths.stem(url).alias("stem"),
        paths.parent(url).alias("parent"),
        paths.strip_affixes(url, "http", "xyz").alias("inner_part"),
    )


@query(
    """WITH k AS (SELECT n_nationkey, CASE WHEN r_name LIKE 'A%' THEN '/' || n_name || '//' || r_name || '_pickle/'
    WHEN r_name LIKE 'E%' THEN n_name || '/../' || r_name WHEN r_name LIKE 'M%' THEN '//'
    ELSE n_name END AS path FROM nation JOIN region ON n_regionkey = r_regionkey),
s AS (SELECT *, list_filter(string_split(path, '/'), lambda p: p <> '') AS parts FROM k),
e AS (SELECT *, CASE WHEN len(parts) = 0 THEN 'collection path cannot resolve to an empty storage path'
    WHEN list_contains(parts, '.') OR list_contains(parts, '..')
      THEN 'collection path contains unsafe segment: ' || path END AS error FROM s)
SELECT n_nationkey, error, CASE WHEN error IS NULL THEN array_to_string(parts, '/') END AS storage_path,
  CASE WHEN error IS NULL THEN array_to_string(list_transform(parts,
    lambda p: CASE WHEN ends_with(p, '_pickle') THEN p ELSE p || '_pickle' END), '/') END AS processed_path,
  CASE WHEN error IS NULL THEN 'processed/' || array_to_string(list_transform(parts,
    lambda p: CASE WHEN ends_with(p, '_pickle') THEN p ELSE p || '_pickle' END), '/') || '/' || n_nationkey
    || '/manifest.json' ELSE 'processed/' || n_nationkey || '/manifest.json' END AS manifest_key FROM e"""
)
def storage_paths(spark, sf):
    region = table(spark, sf, "region")
    nation = table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    path = (
        F.when(F.col("r_name").startswith("A"), F.concat(F.lit("/"), "n_name", F.lit("//"), "r_name", F.lit("_pickle/")))
        .when(F.col("r_name").startswith("E"), F.concat("n_name", F.lit("/../"), "r_name"))
        .when(F.col("r_name").startswith("M"), F.lit("//"))
        .otherwise(F.col("n_name"))
    )
    located = nation.select("n_nationkey", paths.collection_storage_path(path).alias("s"))
    processed = paths.processed_storage_path(F.col("s.path"))
    return located.select(
        "n_nationkey",
        F.col("s.error").alias("error"),
        F.col("s.path").alias("storage_path"),
        processed.alias("processed_path"),
        paths.manifest_key("/processed/", processed, F.col("n_nationkey")).alias("manifest_key"),
    )


@query(
    """WITH k AS (SELECT p_partkey, p_brand, CASE p_type WHEN 'ECONOMY' THEN 'pdf' WHEN 'SMALL' THEN '.docx'
    WHEN 'LARGE' THEN 'a/b' END AS ext, CASE WHEN p_size < 25 THEN 'report.v1.PDF' ELSE 'report' END AS file FROM part),
x AS (SELECT *, coalesce(ext, nullif(regexp_extract(file, '^.+(\\.[^.]+)$', 1), '')) AS got FROM k),
d AS (SELECT *, CASE WHEN starts_with(got, '.') THEN got ELSE '.' || got END AS dotted FROM x)
SELECT p_partkey, CASE WHEN got IS NULL THEN 'document file extension is required for raw storage path'
    WHEN contains(dotted, '/') THEN 'unsafe document file extension: ' || dotted END AS error,
  CASE WHEN got IS NOT NULL AND NOT contains(dotted, '/') THEN p_brand || '/' || p_partkey || dotted END AS path FROM d"""
)
def raw_storage_path(spark, sf):
    kind = F.col("p_type")
    ext = F.when(kind == "ECONOMY", F.lit("pdf")).when(kind == "SMALL", F.lit(".docx")).when(kind == "LARGE", F.lit("a/b"))
    name = F.when(F.col("p_size") < 25, F.lit("report.v1.PDF")).otherwise(F.lit("report"))
    located = paths.raw_storage_path(F.col("p_brand"), F.col("p_partkey"), ext, name)
    parts = table(spark, sf, "part").select("p_partkey", located.alias("s"))
    return parts.select("p_partkey", F.col("s.error").alias("error"), F.col("s.path").alias("path"))


@query(
    """WITH k AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'nas://' || source || '/raw/' || doc_id || '%20x.pdf'
    WHEN 'fr' THEN 'nas://raw/raw/' || doc_id || '.pdf' WHEN 'de' THEN 'file:///data/' || doc_id || '%2B.pdf'
    WHEN 'es' THEN 'plain/' || doc_id || '.pdf' ELSE 's3://b/' || doc_id END AS uri, lang, source FROM documents)
SELECT doc_id, CASE lang WHEN 'en' THEN '/mnt/kb/' || source || '/raw/' || doc_id || ' x.pdf'
    WHEN 'fr' THEN '/mnt/kb/' || doc_id || '.pdf' WHEN 'de' THEN '/data/' || doc_id || '+.pdf'
    WHEN 'es' THEN uri END AS path,
  CASE WHEN lang NOT IN ('en', 'fr', 'de', 'es') THEN 'Unsupported raw_uri scheme: s3' END AS error FROM k"""
)
def resolve_raw_uri(spark, sf):
    doc, lang = F.col("doc_id").cast("string"), F.col("lang")
    uri = (
        F.when(lang == "en", F.concat(F.lit("nas://"), "source", F.lit("/raw/"), doc, F.lit("%20x.pdf")))
        .when(lang == "fr", F.concat(F.lit("nas://raw/raw/"), doc, F.lit(".pdf")))
        .when(lang == "de", F.concat(F.lit("file:///data/"), doc, F.lit("%2B.pdf")))
        .when(lang == "es", F.concat(F.lit("plain/"), doc, F.lit(".pdf")))
        .otherwise(F.concat(F.lit("s3://b/"), doc))
    )
    docs = table(spark, sf, "documents").select("doc_id", paths.resolve_raw_uri(uri, "/mnt/kb").alias("s"))
    return docs.select("doc_id", F.col("s.path").alias("path"), F.col("s.error").alias("error"))


@query(
    """SELECT doc_id, CASE lang WHEN 'en' THEN '.pdf' WHEN 'fr' THEN '.json' WHEN 'de' THEN '.html' END AS ext
FROM documents"""
)
def extension_of(spark, sf):
    lang = F.col("lang")
    kind = (
        F.when(lang == "en", F.lit("application/pdf"))
        .when(lang == "fr", F.lit("Application/JSON"))
        .when(lang == "de", F.lit("text/html"))
        .otherwise(F.lit("x/none"))
    )
    return table(spark, sf, "documents").select("doc_id", paths.extension_of(kind).alias("ext"))


@query(
    """WITH k AS (SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 'F' THEN strftime(o_orderdate, '%Y-%m') ELSE 'unknown' END AS text, o_orderstatus FROM orders)
SELECT o_orderkey, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS epoch_seconds,
  CASE o_orderstatus WHEN 'P' THEN CAST(floor(epoch(o_orderdate)) AS BIGINT)
    WHEN 'F' THEN CAST(floor(epoch(date_trunc('month', o_orderdate))) AS BIGINT) ELSE 1700000000 END AS parsed,
  CASE WHEN o_orderstatus = 'F' THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS month FROM k"""
)
def epoch_dates(spark, sf):
    state = F.col("o_orderstatus")
    text = (
        F.when(state == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(state == "F", F.date_format("o_orderdate", "yyyy-MM"))
        .otherwise(F.lit("unknown"))
    )
    orders = table(spark, sf, "orders").withColumn("text", text)
    return orders.select(
        "o_orderkey",
        dates.to_epoch(F.col("o_orderdate")).alias("epoch_seconds"),
        dates.to_unix_or_now(F.col("text"), 1700000000).alias("parsed"),
        F.when(state == "F", dates.year_month(F.col("text")).cast("string")).alias("month"),
    )


@query(
    """SELECT n_nationkey, n_name || '，' || r_name AS wide, n_name || '. ' || r_name AS dotted FROM nation
JOIN region ON n_regionkey = r_regionkey"""
)
def join_names(spark, sf):
    region = table(spark, sf, "region")
    nation = table(spark, sf, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    names = F.array("n_name", "r_name")
    return nation.select(
        "n_nationkey", tx.join_names(names, "，").alias("wide"), tx.join_names(names, ". ").alias("dotted")
    )


@query(
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) - 7200 AS instant, CAST(floor(epoch(ts)) AS BIGINT) AS wall FROM events"""
)
def epoch_instants(spark, sf):
    """Instants written down two hours east of Greenwich, and the same times without a zone."""
    written = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    events = table(spark, sf, "events").withColumn("instant", F.to_timestamp_ltz(written, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSXXX")))
    return events.select(
        "event_id", dates.to_epoch(F.col("instant")).alias("instant"), dates.to_epoch(F.col("ts").cast("timestamp_ntz")).alias("wall")
    )


@query(
    f"""WITH {ELEMENTS}, q AS (
  SELECT doc_id, pos, CASE WHEN pos % 3 = 1 THEN text || ' [q-' || pos || '] [x]' ELSE text END AS text FROM e),
r AS (SELECT doc_id, pos, translate(text, '[]', chr(39) || chr(39)) AS text FROM q),
f AS (SELECT doc_id, arg_min(text, pos) AS text FROM r WHERE contains(text, 'an') GROUP BY doc_id)
SELECT doc_id, CASE WHEN text LIKE '%' || chr(39) || '%' || chr(39) || '%' THEN string_split(text, chr(39))[2] ELSE text END AS quoted FROM f"""
)
def first_quoted_elements(spark, sf):
    """The first element with the marker may stand anywhere; some quote a name, others are the name."""
    name = F.concat("text", F.lit(" 'q-"), F.col("pos"), F.lit("' 'x'"))
    elements = document_elements(spark, sf).withColumn("text", F.when(F.col("pos") % 3 == 1, name).otherwise(F.col("text")))
    elements = elements.withColumn("text", F.translate("text", "[]", "''"))
    return tx.first_quoted_of(elements, "an")


@query(
    """SELECT conv_id, turn, substr(text, 1, 40) AS clipped,
  CASE WHEN role = 'user' THEN 'r-' || turn END AS quoted,
  CASE WHEN turn > 0 THEN 'Page ' || turn || ': ' || role ELSE role END AS paged FROM conversations"""
)
def text_snippets(spark, sf):
    turn = F.col("turn").cast("string")
    marker = F.when(F.col("role") == "user", F.concat(F.lit("of 'r-"), turn, F.lit("' in 'x'"))).otherwise("none")
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        tx.clip(F.col("text"), 40).alias("clipped"),
        tx.first_quoted(marker).alias("quoted"),
        tx.page_prefix(F.col("turn"), F.col("role")).alias("paged"),
    )


@query(
    """SELECT page_id, sha256(html) AS digest, to_base64(encode(html)) AS payload FROM pages"""
)
def file_digests(spark, sf):
    """Digest and base64 payload of whole files."""
    raw = F.encode("html", "UTF-8")
    return table(spark, sf, "pages").select(
        "page_id", values.sha256(raw).alias("digest"), F.replace(F.base64(raw), F.lit("\r\n"), F.lit("")).alias("payload")
    )


@query("""SELECT event_id, sha256('{"a": "清华", "k": ' || json_extract_string(props, '$.k') || '}') AS digest FROM events""")
def canonical_json_hash(spark, sf):
    """Keys given in the wrong order, without spaces."""
    k = F.get_json_object("props", "$.k")
    text = F.concat(F.lit('{"k":'), k, F.lit(',"a":"清华"}'))
    return table(spark, sf, "events").select("event_id", values.canonical_json_hash(text).alias("digest"))


@query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k')
  WHEN 'view' THEN 'x' END AS value FROM events"""
)
def json_first(spark, sf):
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    obj = (
        F.when(kind == "click", F.concat(F.lit('{"result": null, "Result": "'), k, F.lit('"}')))
        .when(kind == "view", F.lit('{"Result": "y", "result": "x"}'))
        .otherwise(F.lit('{"result": "", "Result": []}'))
    )
    return table(spark, sf, "events").select("event_id", values.json_first(obj, "result", "Result").alias("value"))


@query(
    """WITH k AS (SELECT vec_id, list_transform(embedding[1:16], lambda v: CAST(v AS DOUBLE)) AS v FROM embeddings),
n AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM k)
SELECT vec_id, round(v[1] / norm, 6) AS first_value, round(v[16] / norm, 6) AS last_value, len(v) AS dims,
  'EMBEDDING_DIMENSION_TOO_SMALL: got 64, need 100' AS error FROM n"""
)
def l2_truncate(spark, sf):
    vector = values.l2_truncate(F.col("embedding"), 16)
    rows = table(spark, sf, "embeddings").select(
        "vec_id", vector.alias("v"), values.l2_error(F.col("embedding"), 100).alias("error")
    )
    return rows.select(
        "vec_id",
        F.round(F.col("v")[0], 6).alias("first_value"),
        F.round(F.col("v")[15], 6).alias("last_value"),
        F.size("v").cast("long").alias("dims"),
        "error",
    )


@query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'plain' WHEN 'view' THEN props WHEN 'error' THEN ''
    WHEN 'signup' THEN '' END AS text,
  CASE WHEN event_type = 'purchase' THEN 'EMBEDDING_CHUNK_NOT_OBJECT' END AS error FROM events"""
)
def chunk_text(spark, sf):
    kind = F.col("event_type")
    item = (
        F.when(kind == "click", F.lit('{"text": "plain"}'))
        .when(kind == "view", F.concat(F.lit('{"text":'), F.col("props"), F.lit("}")))
        .when(kind == "error", F.lit('{"text": null}'))
        .when(kind == "signup", F.lit('{"page": 1}'))
        .otherwise(F.lit("[1, 2]"))
    )
    events = table(spark, sf, "events").select("event_id", values.chunk_text(item).alias("s"))
    return events.select("event_id", F.col("s.text").alias("text"), F.col("s.error").alias("error"))


@query(
    """SELECT p_partkey, nullif(TRY_CAST(CASE p_type WHEN 'SMALL' THEN '' WHEN 'LARGE' THEN '0'
    ELSE CAST(p_size AS VARCHAR) END AS INTEGER), 0) AS year,
  CASE p_type WHEN 'SMALL' THEN p_name WHEN 'LARGE' THEN p_name WHEN 'ECONOMY' THEN p_name ELSE p_brand END AS authors
FROM part"""
)
def bibliography_fields(spark, sf):
    kind = F.col("p_type")
    year = F.when(kind == "SMALL", F.lit("")).when(kind == "LARGE", F.lit("0")).otherwise(F.col("p_size").cast("string"))
    extra = F.when(kind == "SMALL", F.lit("None")).when(kind == "LARGE", F.lit("[]")).when(kind != "ECONOMY", F.col("p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey", values.int_or_null(year).alias("year"), values.authors(extra, F.col("p_name")).alias("authors")
    )


_FAILURES = [
    ("parser", "parser http error 429: busy", True),
    ("parser", "parser http error 404: gone", False),
    ("parser", "parser response missing txt", False),
    ("embedding", "embedding request failed: x", True),
    ("other", "EMPTY_RESULT", False),
]
_EVENT_OF = ["click", "view", "error", "signup", "purchase"]


def _case(column: int) -> str:
    whens = " ".join(
        f"WHEN '{e}' THEN {f[column] if column == 2 else repr(f[column])}" for e, f in zip(_EVENT_OF, _FAILURES)
    )
    return f"CASE event_type {whens} END"


@query(
    f"""SELECT event_id, {_case(2)} AS retry_parse, event_type <> 'view' OR value > 5 AS retry_ready,
  CAST(2 ** greatest(0, CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 - 1) AS DOUBLE) AS wait_seconds FROM events"""
)
def failure_rules(spark, sf):
    kind = F.col("event_type")
    error_class, message = F.lit(None).cast("string"), F.lit(None).cast("string")
    for event, (name, text, _) in zip(_EVENT_OF, _FAILURES):
        error_class = F.when(kind == event, F.lit(name)).otherwise(error_class)
        message = F.when(kind == event, F.lit(text)).otherwise(message)
    ready = F.when((kind == "view") & (F.col("value") <= 5), F.lit("S3_ARTIFACT_MISMATCH: a sha256")).otherwise(
        F.lit("S3_NOT_READY_AFTER_TIMEOUT: x")
    )
    attempt = F.get_json_object("props", "$.k").cast("int") % 8
    return table(spark, sf, "events").select(
        "event_id",
        status.retryable_parse(error_class, message).alias("retry_parse"),
        status.retryable_ready(F.lit("runtime"), ready).alias("retry_ready"),
        status.backoff(attempt).alias("wait_seconds"),
    )
