"""Queries on ordered chunks: the turns of a conversation stand for the chunks of a document."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import filters, merging, sections, tables
from ..operators.segments import longest_document
from ..plans import domains
from ..sinks import records
from .registry import CHUNKS, ELEMENTS, SPACE, conversation_chunks, document_elements, longest_text, merged_sql, query, table, tokens

LO, HI = 65, 230


@query(f"WITH {CHUNKS}, {merged_sql(LO, HI)} SELECT * FROM m")
def merge_small_chunks(spark, sf):
    merged = merging.merge_small_chunks(conversation_chunks(spark, sf), LO, HI, tables=False)
    return merged.drop("idx")


_UNSPACED = "u AS (SELECT * REPLACE (replace(replace(text, ' ', ''), chr(10), '') AS text) FROM c)"


@query(f"WITH {CHUNKS}, {_UNSPACED}, {merged_sql(LO, HI, 'u')} SELECT * FROM m")
def merge_small_chunks_unspaced(spark, sf):
    """The same on texts without a space: chunks keep their sizes, so documents do not end in one row."""
    text = F.regexp_replace("text", "[ \n]", "")
    return merging.merge_small_chunks(conversation_chunks(spark, sf).withColumn("text", text), LO, HI, tables=False).drop("idx")


@query(
    f"""WITH {CHUNKS}, t AS (
  SELECT doc_id, pos, title, page_number, text || '<p>see</p><table><tr><td>' || title || '</td><td>' || pos
    || '</td></tr></table>' AS text FROM c), {merged_sql(LO, HI, 't')}
SELECT * FROM m
UNION ALL
SELECT doc_id, pos, 0 AS sub, '<table><tr><td>' || title || '</td><td>' || pos || '</td></tr></table>' AS text,
  page_number FROM t WHERE {tokens('text')} > {HI}"""
)
def merge_chunks_with_tables(spark, sf):
    text = F.concat(
        "text", F.lit("<p>see</p><table><tr><td>"), "title", F.lit("</td><td>"), F.col("pos").cast("string"),
        F.lit("</td></tr></table>"),
    )
    chunks = conversation_chunks(spark, sf).withColumn("text", text)
    return merging.merge_small_chunks(chunks, LO, HI, longest=longest_document(chunks)).drop("idx")


@query(
    f"""WITH {CHUNKS}, {merged_sql(LO, HI)}
SELECT m.doc_id, m.text, page_number, d.lang, d.source,
  row_number() OVER (PARTITION BY m.doc_id ORDER BY pos) - 1 AS idx,
  m.doc_id || '_' || (row_number() OVER (PARTITION BY m.doc_id ORDER BY pos) - 1) AS chunk_id
FROM m JOIN documents d USING (doc_id)"""
)
def index_ready_chunks(spark, sf):
    """Merge, clean, number and attach metadata: the core of every index build."""
    chunks = conversation_chunks(spark, sf)
    meta = table(spark, sf, "documents").select("doc_id", "lang", "source")
    merged = merging.merge_small_chunks(
        chunks, LO, HI, tables=False, meta=meta, longest=longest_document(chunks)
    )
    cleaned = merged.withColumn("text", tx.fix_utf8(F.col("text")))
    return cleaned.select("doc_id", "text", "page_number", "lang", "source", "idx", merging.chunk_id().alias("chunk_id"))


@query(
    f"""WITH {CHUNKS} SELECT doc_id, text, row_number() OVER w - 1 AS idx,
  doc_id || '_' || (row_number() OVER w - 1) AS chunk_id
FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY pos)"""
)
def assign_chunk_ids(spark, sf):
    return merging.assign_chunk_ids(conversation_chunks(spark, sf)).select("doc_id", "text", "idx", "chunk_id")


@query(
    f"""WITH {CHUNKS}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS idx FROM c)
SELECT doc_id, idx, doc_id || '_' || idx AS chunk_id FROM k WHERE title <> 'user'"""
)
def skip_blank_keep_index(spark, sf):
    """The turns of the user count as blank."""
    text = F.when(F.col("title") == "user", F.lit(" \n")).otherwise(F.col("text"))
    records_ = conversation_chunks(spark, sf).withColumn("text", text)
    return merging.skip_blank_keep_index(records_).select("doc_id", "idx", "chunk_id")


ATTACH_SQL = f"""WITH {CHUNKS}, k AS (
  SELECT *, title = 'assistant' AS is_table, CASE WHEN len(text) > 600 THEN '<i>' || title || '</i>' END AS html FROM c),
r AS (SELECT * FROM k WHERE {{keep}}),
g AS (SELECT *, sum(CAST(NOT is_table AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM r)
SELECT doc_id, min(pos) AS pos,
  string_agg(CASE WHEN is_table THEN coalesce(html, text) ELSE text END, {{sep}} ORDER BY pos) AS text,
  arg_min(page_number, pos) AS page_number
FROM g GROUP BY doc_id, grp"""


def _kinds(spark, sf):
    return conversation_chunks(spark, sf).select(
        "doc_id",
        "pos",
        F.when(F.col("title") == "assistant", F.lit("Table")).otherwise(F.lit("Composite")).alias("kind"),
        "text",
        F.when(F.length("text") > 600, F.concat(F.lit("<i>"), "title", F.lit("</i>"))).alias("html"),
        "page_number",
    )


@query(ATTACH_SQL.format(keep="true", sep="chr(10)"))
def attach_tables(spark, sf):
    return merging.attach_tables(_kinds(spark, sf), "\n", "text")


@query(ATTACH_SQL.format(keep="NOT is_table OR html IS NOT NULL", sep="chr(10) || chr(10)"))
def attach_tables_skip_null_html(spark, sf):
    return merging.attach_tables(_kinds(spark, sf), "\n\n", "skip")


@query(
    f"""WITH {ELEMENTS}, k AS (
  SELECT *, len(trim(text, {SPACE})) > 0 AND NOT ends_with(trim(text, {SPACE}), '.') AS is_title FROM e),
g AS (SELECT *,
    coalesce(sum(CAST(NOT is_title AS INTEGER)) OVER
      (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp,
    sum(CAST(NOT is_title AS INTEGER)) OVER (PARTITION BY doc_id) AS bodies FROM k)
SELECT doc_id, min(pos) AS pos,
  string_agg(CASE WHEN is_title THEN trim(text, {SPACE}) ELSE text END, chr(10) ORDER BY pos) AS text
FROM g GROUP BY doc_id, CASE WHEN grp = bodies AND bodies > 0 THEN grp - 1 ELSE grp END"""
)
def merge_title_blocks(spark, sf):
    return merging.merge_title_blocks(document_elements(spark, sf), longest=longest_text(spark, sf))


@query(
    f"""WITH {CHUNKS}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i,
    count(*) OVER (PARTITION BY doc_id) AS n FROM c),
l AS (SELECT *, lead(text) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM k)
SELECT doc_id, pos, CASE WHEN i = n - 1 AND len(nxt) < 150 THEN text || ' ' || nxt ELSE text END AS text
FROM l WHERE NOT (i = n AND n >= 2 AND len(text) < 150)"""
)
def absorb_short_tail(spark, sf):
    return merging.absorb_short_tail(conversation_chunks(spark, sf).select("doc_id", "pos", "text"), 150)


@query(
    f"""WITH {CHUNKS}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS i FROM c)
SELECT doc_id, i // 3 AS grp, string_agg(text, ' ' ORDER BY pos) AS text
FROM k GROUP BY doc_id, i // 3 HAVING count(*) = 3"""
)
def fixed_groups(spark, sf):
    return merging.fixed_groups(conversation_chunks(spark, sf), 3)


def _titled(spark, sf):
    text = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n"))
    return conversation_chunks(spark, sf).select("doc_id", "pos", text.alias("text"))


TITLED = f"""{CHUNKS}, k AS (
  SELECT doc_id, pos, replace(text, chr(10), chr(10) || chr(10)) AS text,
    instr(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) AS cut FROM c)"""


@query(
    f"""WITH {TITLED} SELECT doc_id, pos, CASE WHEN cut > 0 THEN substr(text, 1, cut - 1) ELSE text END AS title,
  CASE WHEN cut > 0 THEN substr(text, cut + 2) ELSE '' END AS content FROM k"""
)
def split_title_plain(spark, sf):
    return merging.title_content(_titled(spark, sf), "plain").drop("text")


@query(
    f"""WITH {TITLED}, p AS (
  SELECT doc_id, pos, CASE WHEN cut > 0 THEN substr(text, 1, cut - 1) ELSE 'default' END AS title,
    CASE WHEN cut > 0 THEN substr(text, cut + 2) ELSE text END AS content FROM k)
SELECT doc_id, pos, title, CASE WHEN content = '' THEN 'default' ELSE content END AS content FROM p"""
)
def split_title_default(spark, sf):
    return merging.title_content(_titled(spark, sf), "default").drop("text")


@query(
    f"""WITH {TITLED}, p AS (
  SELECT *, cut > 0 AND len(trim(substr(text, 1, cut - 1), {SPACE})) > 0 AS good FROM k)
SELECT doc_id, pos, CASE WHEN good THEN substr(text, 1, cut - 1) ELSE 'Default Title' END AS title,
  CASE WHEN good THEN substr(text, cut + 2) ELSE text END AS content FROM p"""
)
def split_title_default_title(spark, sf):
    return merging.title_content(_titled(spark, sf), "default_title").drop("text")


@query(
    f"""WITH {TITLED} SELECT doc_id, pos, substr(text, 1, cut - 1) AS title, substr(text, cut + 2) AS content
FROM k WHERE cut > 0"""
)
def split_title_drop(spark, sf):
    return merging.title_content(_titled(spark, sf), "drop").drop("text")


@query(
    f"""WITH {TITLED} SELECT doc_id, pos, string_split(text, chr(10))[1] AS title,
  CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS content FROM k"""
)
def split_title_first_line(spark, sf):
    return merging.title_content(_titled(spark, sf), "first_line").drop("text")


@query(
    f"""WITH {TITLED} SELECT doc_id, pos,
  last_value(CASE WHEN cut > 0 THEN substr(text, 1, cut - 1) END IGNORE NULLS) OVER
    (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS title,
  text AS content FROM k"""
)
def title_content_carry(spark, sf):
    return merging.title_content(_titled(spark, sf), "carry").drop("text")


@query("SELECT conv_id AS doc_id, max(turn) AS pos, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def latest_per_key(spark, sf):
    log = conversation_chunks(spark, sf).select("doc_id", "pos", "text")
    return merging.latest_per_key(log, ["doc_id"], "pos")


@query(f"WITH {CHUNKS} SELECT doc_id, pos, text FROM c WHERE title <> 'system'")
def drop_empty_chunks(spark, sf):
    """The turns of the system count as blank."""
    text = F.when(F.col("title") == "system", F.lit(" \n　")).otherwise(F.col("text"))
    chunks = conversation_chunks(spark, sf).withColumn("text", text)
    return filters.drop_empty_chunks(chunks).select("doc_id", "pos", "text")


@query(
    f"""WITH {CHUNKS} SELECT doc_id, count(*) AS n_original, count(*) FILTER (title <> 'system') AS n_kept,
  count(*) FILTER (title = 'system') AS n_dropped FROM c GROUP BY doc_id"""
)
def dropped_chunk_counts(spark, sf):
    text = F.when(F.col("title") != "system", F.col("text"))
    return filters.dropped_chunk_counts(conversation_chunks(spark, sf).withColumn("text", text))


@query(
    f"""WITH {CHUNKS} SELECT doc_id, pos, text FROM c
WHERE pos < (SELECT max(pos) FROM c AS o WHERE o.doc_id = c.doc_id)"""
)
def drop_last_chunk(spark, sf):
    return filters.drop_last_chunk(conversation_chunks(spark, sf)).select("doc_id", "pos", "text")


@query(
    f"""WITH {CHUNKS}, k AS (SELECT *, 'Page ' || page_number || ': ' || text AS body,
  min(pos) OVER (PARTITION BY doc_id) AS first_pos FROM c)
SELECT doc_id, pos // 5 AS part, string_agg(CASE WHEN pos = first_pos THEN body
  ELSE chr(10) || '----------' || chr(10) || body END, '' ORDER BY pos) AS text
FROM k GROUP BY doc_id, pos // 5"""
)
def render_text(spark, sf):
    return merging.render_text(conversation_chunks(spark, sf), "page", part_chunks=5)


@query(
    f"""WITH {CHUNKS} SELECT doc_id, string_agg('Page ' || page_number || ':' || chr(10) || title || chr(10) || text,
  chr(10) || '----------' || chr(10) ORDER BY pos) AS text, CAST(0 AS BIGINT) AS part FROM c GROUP BY doc_id"""
)
def render_text_titled(spark, sf):
    chunks = conversation_chunks(spark, sf).withColumn("content", F.col("text"))
    return merging.render_text(chunks, "titled")


@query(
    f"""WITH {CHUNKS} SELECT doc_id, pos, '{{"page_number": ' || page_number || ', "text": ' || to_json(text)
  || ', "title": ' || to_json(title) || '}}' AS line FROM c"""
)
def chunk_jsonl(spark, sf):
    chunks = conversation_chunks(spark, sf).withColumn("embedding", F.array(F.lit(0.5)))
    return records.chunk_jsonl(chunks)


@query(
    f"""WITH {CHUNKS}, {merged_sql(LO, HI)}, k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS idx FROM m)
SELECT 'chunks' AS "index", doc_id || '_' || idx AS id, idx // 2 AS bulk,
  '{{"index":{{"_index":"chunks","_id":"' || doc_id || '_' || idx || '"}}}}' AS action,
  CAST(to_json({{'text': text, 'rec_id': CAST(doc_id AS VARCHAR), 'page_number': page_number}}) AS VARCHAR) AS source FROM k"""
)
def fulltext_actions(spark, sf):
    merged = merging.merge_small_chunks(conversation_chunks(spark, sf), LO, HI, tables=False)
    ready = merged.withColumns({"rec_id": F.col("doc_id").cast("string"), "chunk_id": merging.chunk_id()})
    return records.fulltext_actions(ready, "chunks", ["text", "rec_id", "page_number"], slice_entries=4)


@query(
    f"""WITH {TITLED} SELECT CASE WHEN cut > 0 THEN substr(text, 1, cut - 1) ELSE text END AS title,
  CASE WHEN cut > 0 THEN substr(text, cut + 2) ELSE '' END AS content, CAST(doc_id AS VARCHAR) AS source,
  CAST(pos // 2 AS INTEGER) AS page_number FROM k"""
)
def text_objects(spark, sf):
    pairs = merging.title_content(_titled(spark, sf), "plain")
    pairs = pairs.withColumn("page_number", F.floor(F.col("pos") / 2).cast("int"))
    return records.text_objects(pairs, F.col("doc_id").cast("string"), with_page=True)


@query(
    f"""WITH {ELEMENTS}, g AS (
  SELECT *, sum(CAST(category = 'Title' AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM e),
s AS (SELECT doc_id, grp, min(pos) AS pos, max(text) FILTER (category = 'Title') AS heading,
    coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (category <> 'Title'), '') AS body
  FROM g WHERE grp > 0 GROUP BY doc_id, grp)
SELECT doc_id, min(pos) AS pos, heading, arg_max(body, pos) AS body
FROM s WHERE heading <> '' GROUP BY doc_id, heading"""
)
def heading_sections(spark, sf):
    paragraphs = document_elements(spark, sf).withColumn("is_heading", F.col("category") == "Title")
    return sections.heading_sections(paragraphs, longest=longest_text(spark, sf))


@query(
    f"""WITH {ELEMENTS}, g AS (
  SELECT *, sum(CAST(category = 'Title' AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM e),
s AS (SELECT doc_id, grp, min(pos) AS pos, max(text) FILTER (category = 'Title') AS heading,
    coalesce(string_agg(text, chr(10) ORDER BY pos) FILTER (category <> 'Title'), '') AS body
  FROM g WHERE grp > 0 GROUP BY doc_id, grp),
l AS (SELECT doc_id, min(pos) AS pos, heading, arg_max(body, pos) AS body
  FROM s WHERE heading <> '' GROUP BY doc_id, heading)
SELECT doc_id, pos, '{{"messages":[{{"role":"system","content":"You are an expert."}},{{"role":"user","content":'
  || to_json(heading) || '}},{{"role":"assistant","content":' || to_json(body) || '}}]}}' AS line FROM l"""
)
def chat_jsonl(spark, sf):
    paragraphs = document_elements(spark, sf).withColumn("is_heading", F.col("category") == "Title")
    return records.chat_jsonl(sections.heading_sections(paragraphs), "You are an expert.")


@query(
    f"""WITH {CHUNKS}, k AS (SELECT *, CASE title WHEN 'user' THEN 'shape' WHEN 'assistant' THEN 'element'
  ELSE 'note' END AS part FROM c),
j AS (SELECT doc_id, page_number AS slide,
    'Page: ' || page_number || chr(10)
    || trim(coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (part = 'shape'), ''), {SPACE})
    || chr(10) || chr(10) || trim(coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (part = 'note'), ''), {SPACE})
    || chr(10) || chr(10) || coalesce(string_agg(text, ' ' ORDER BY pos) FILTER (part = 'element'), '') AS text
  FROM k GROUP BY doc_id, page_number)
SELECT doc_id, slide, string_split(text, chr(10))[1] AS title, text FROM j"""
)
def slide_text(spark, sf):
    part = (
        F.when(F.col("title") == "user", F.lit("shape"))
        .when(F.col("title") == "assistant", F.lit("element"))
        .otherwise(F.lit("note"))
    )
    shapes = conversation_chunks(spark, sf).select(
        "doc_id", F.col("page_number").alias("slide"), "pos", part.alias("part"), "text"
    )
    return sections.slide_text(shapes, with_page=True)


@query(
    f"""WITH {CHUNKS} SELECT doc_id, count(*) FILTER (title <> 'system') AS chunk_count,
  count(*) AS original_chunk_count, count(*) FILTER (title = 'system') AS dropped_empty_text_count,
  'a' || max(pos) AS artifact_uuid FROM c GROUP BY doc_id"""
)
def document_rollup(spark, sf):
    from ..operators.aggregates import document_rollup as rollup

    chunks = conversation_chunks(spark, sf).select(
        "doc_id",
        F.when(F.col("title") != "system", F.col("text")).alias("text"),
        F.concat(F.lit("a"), F.col("pos").cast("string")).alias("artifact_uuid"),
    )
    return rollup(chunks)


# One table per document, one row per line; the line is the second cell.
LIMIT = 120
_ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_HEAD = (
    '<table class="dataframe">\n  <thead>\n    <tr style="text-align: right;">\n'
    "      <th>0</th>\n      <th>1</th>\n    </tr>\n  </thead>\n  <tbody>\n"
)
_TAIL = "  </tbody>\n</table>"


@query(
    f"""WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
r AS (SELECT doc_id, i, '    <tr>' || chr(10) || '      <td>row ' || (i - 1) || '</td>' || chr(10)
    || '      <td>' || {_ESCAPED.format("trim(regexp_replace('line: ' || line, '[\\r\\n]+|\\s{2,}', ' ', 'g'))")}
    || '</td>' || chr(10) || '    </tr>' || chr(10) AS html FROM l),
n AS (SELECT *, {tokens(f"'{_HEAD}' || html || '{_TAIL}'")} AS n FROM r),
a AS (SELECT doc_id, list(html ORDER BY i) AS rows, list(n ORDER BY i) AS sizes FROM n GROUP BY doc_id),
b AS (SELECT doc_id, rows, list_reduce(list_prepend({{'acc': 0, 'part': 0, 'parts': []::BIGINT[], 'n': 0}},
    list_transform(sizes, lambda s: {{'acc': 0, 'part': 0, 'parts': []::BIGINT[], 'n': s}})),
    lambda x, y: CASE WHEN x.acc + y.n > {LIMIT} AND x.acc > 0
      THEN {{'acc': y.n, 'part': x.part + 1, 'parts': list_append(x.parts, x.part + 1), 'n': 0}}
      ELSE {{'acc': x.acc + y.n, 'part': x.part, 'parts': list_append(x.parts, x.part), 'n': 0}} END).parts AS parts
  FROM a),
u AS (SELECT doc_id, unnest(rows) AS html, unnest(parts) AS part, generate_subscripts(rows, 1) AS i FROM b)
SELECT doc_id, CAST(part AS INTEGER) AS sub,
  '{_HEAD}' || string_agg(html, '' ORDER BY i) || '{_TAIL}' AS text
FROM u GROUP BY doc_id, part"""
)
def split_table_rows(spark, sf):
    """Tables longer than the limit, cut between rows with the header repeated."""
    cells = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.concat(
            F.lit("<tr><td>row "), i.cast("string"), F.lit("</td><td>line: "),
            F.replace(F.replace(F.replace(line, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                      F.lit(">"), F.lit("&gt;")),
            F.lit("</td></tr>"),
        ),
    )
    html = F.concat(F.lit("<table>"), F.array_join(cells, ""), F.lit("</table>"))
    docs = table(spark, sf, "documents").select("doc_id", html.alias("html"))
    parts = docs.select("doc_id", tables.split_table_rows(F.col("html"), LIMIT).alias("parts"))
    # The outer form keeps the optimizer from running the split once more to test for empty arrays.
    return parts.select("doc_id", F.posexplode_outer("parts").alias("sub", "text")).filter("text is not null")


@query(
    """WITH k AS (SELECT conv_id AS doc_id, turn AS pos, role FROM conversations)
SELECT doc_id, pos, u.sub, u.text FROM k, LATERAL (
  SELECT 0 AS sub, '<table border="1"><tr><td>' || role || ' <br/> x</td><td><table><tr><td>' || pos
    || '</td></tr></table></td></tr></table>' AS text
  UNION ALL SELECT 1, '<table><tr><td>' || pos || '</td></tr></table>') u"""
)
def extract_tables(spark, sf):
    """Outer and nested tables of each chunk."""
    text = F.concat(
        F.col("text"), F.lit("<TABLE border=1><tr><td>"), F.col("title"), F.lit(" <br> x</td><td><table><tr><td>"),
        F.col("pos").cast("string"), F.lit("</table></table> after"),
    )
    chunks = conversation_chunks(spark, sf).select("doc_id", "pos", text.alias("text"))
    found = chunks.select("doc_id", "pos", tables.extract_tables(F.col("text")).alias("found"))
    return found.select("doc_id", "pos", F.posexplode_outer("found").alias("sub", "text")).filter("text is not null")


def _domain_meta(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.col("source").alias("course"),
        F.col("lang").alias("name"),
        F.col("n_chars").cast("string").alias("chapter_number"),
        F.col("source").alias("title"),
        F.col("lang").alias("tag"),
        F.col("source").alias("report_title"),
        F.col("lang").alias("country"),
        F.col("source").alias("company_name"),
        F.array("source", "lang").alias("authors"),
        F.array("source", "lang").alias("issuing_organization"),
        F.col("n_chars").cast("string").alias("isbn_number"),
        F.col("n_chars").cast("string").alias("standard_number"),
        F.lit("2020-05").alias("publish_time"),
        F.lit("2021-07").alias("date"),
        F.concat(F.lit("http://x/"), F.col("source")).alias("url"),
        F.col("source").alias("journal"),
        F.lit("2020-01-02 03:04:05").cast("timestamp_ntz").alias("publication_date"),
        F.lit("2020-01-02 03:04:05").cast("timestamp_ntz").alias("report_start_date"),
        F.lit("2020-01-03 00:00:00").cast("timestamp_ntz").alias("report_end_date"),
        F.lit("2020-01-03 00:00:00").cast("timestamp_ntz").alias("release_date"),
        F.lit("2020-01-03 00:00:00").cast("timestamp_ntz").alias("effective_date"),
    )


def _conversation_domain(name, spark, sf):
    chunks = conversation_chunks(spark, sf)
    meta = _domain_meta(spark, sf)
    fulltext, _, _ = domains.build_index(name, chunks, meta, lo=LO, hi=HI, longest=longest_document(chunks))
    return fulltext


def _domain_sql(index, fields, id_field="rec_id", source="c", extra=""):
    """Full-text rows of a kind of source; fields are SQL expressions over m (chunks) and d (metadata)."""
    pairs = ", ".join(f"'{k}': {v}" for k, v in fields.items())
    return f"""WITH {CHUNKS}{extra}, {merged_sql(LO, HI, source)}, k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS idx FROM m)
SELECT '{index}' AS "index", k.doc_id || '_' || idx AS id, idx // 250 AS bulk,
  '{{"index":{{"_index":"{index}","_id":"' || k.doc_id || '_' || idx || '"}}}}' AS action,
  CAST(to_json({{{pairs}}}) AS VARCHAR) AS source
FROM k JOIN documents d USING (doc_id)"""


_BASE = {"text": "k.text", "rec_id": "CAST(k.doc_id AS VARCHAR)"}
_T1, _T2 = 1577934245, 1578009600


@query(
    _domain_sql(
        "esg",
        {**_BASE, "page_number": "k.page_number", "title": "d.source", "country": "d.lang",
         "company_name": "d.source", "publication_date": _T1, "report_start_date": _T1,
         "report_end_date": _T2},
    )
)
def domain_esg(spark, sf):
    return _conversation_domain("esg", spark, sf)


@query(
    _domain_sql(
        "edu",
        {**_BASE, "course": "d.source", "name": "d.lang", "chapter_number": "CAST(d.n_chars AS VARCHAR)"},
    )
)
def domain_education(spark, sf):
    return _conversation_domain("education", spark, sf)


@query(
    _domain_sql(
        "textbooks",
        {**_BASE, "page_number": "k.page_number", "title": "d.source", "author": "d.source || ', ' || d.lang",
         "isbn_number": "CAST(d.n_chars AS VARCHAR)", "publication_date": 1588291200},
    )
)
def domain_textbooks(spark, sf):
    return _conversation_domain("textbooks", spark, sf)


@query(
    _domain_sql(
        "sci",
        {"text": "k.text", "doi": "CAST(k.doc_id AS VARCHAR)", "journal": "d.source", "date": 1625097600},
    )
)
def domain_journals(spark, sf):
    return _conversation_domain("journals", spark, sf)


@query(
    _domain_sql(
        "reports",
        {**_BASE, "title": "d.source", "organization": "d.source || '，' || d.lang", "release_date": _T2,
         "url": "'http://x/' || d.source"},
    )
)
def domain_reports(spark, sf):
    return _conversation_domain("reports", spark, sf)


@query(
    _domain_sql(
        "standards",
        {**_BASE, "title": "d.source", "standard_number": "CAST(d.n_chars AS VARCHAR)",
         "organization": "d.source || '，' || d.lang", "effective_date": _T2},
    )
)
def domain_standards(spark, sf):
    return _conversation_domain("standards", spark, sf)


@query(
    _domain_sql(
        "internal_use",
        {**_BASE, "title": "d.source", "tag": "d.lang"},
        source="x",
        extra=", x AS (SELECT * FROM c WHERE pos < (SELECT max(pos) FROM c AS o WHERE o.doc_id = c.doc_id))",
    )
)
def domain_internal(spark, sf):
    return _conversation_domain("internal", spark, sf)


_VECTORS = {"esg": ("esg", "d.source"), "education": ("education", "d.source"), "textbooks": ("textbook", "d.source"),
            "journals": ("sci", "d.source"), "reports": ("report", "d.source || '. ' || d.lang"),
            "standards": ("standard", "d.source || '，' || d.lang")}
_SHOWN_FIELD = {"esg": "title", "education": "course", "textbooks": "title", "journals": "journal",
                "reports": "organization", "standards": "organization"}


def _word_embedder():
    """One value per text, the number of its words, and a constant."""
    return lambda texts: [{"index": i, "embedding": [t.count(" ") + 1, 1]} for i, t in enumerate(texts)]


@query(
    f"""WITH {CHUNKS}, {merged_sql(LO, HI)}, k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS idx,
    CAST(len(string_split(replace(replace(text, chr(10) || chr(10), ' '), chr(10), ' '), ' ')) AS DOUBLE) AS n FROM m)
"""
    + " UNION ALL ".join(
        f"""SELECT '{namespace}' AS namespace, k.doc_id || '_' || idx AS id, k.text, {shown} AS shown,
  round(n / sqrt(n * n + 1), 5) AS first_value FROM k JOIN documents d USING (doc_id)"""
        for namespace, shown in _VECTORS.values()
    )
)
def domain_vectors(spark, sf):
    """Vector records of the kinds of source, each with the field that names its origin."""
    chunks, meta = conversation_chunks(spark, sf), _domain_meta(spark, sf)
    longest, out = longest_document(chunks), None
    for name, shown in _SHOWN_FIELD.items():
        _, found, _ = domains.build_index(
            name, chunks, meta, _word_embedder, dims=2, lo=LO, hi=HI, longest=longest
        )
        rows = found.select(
            "namespace",
            "id",
            F.col("metadata.text").alias("text"),
            F.col(f"metadata.{shown}").alias("shown"),
            F.round(F.element_at("values", 1).cast("double"), 5).alias("first_value"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"WITH {CHUNKS} SELECT c.doc_id, pos, c.text, d.lang FROM c JOIN documents d USING (doc_id) WHERE d.lang <> 'de'")
def attach_metadata(spark, sf):
    """Chunks of German documents have no metadata row and are left out."""
    from ..operators.joins import attach_metadata as attach

    meta = table(spark, sf, "documents").filter("lang <> 'de'").select("doc_id", "lang")
    return attach(conversation_chunks(spark, sf).select("doc_id", "pos", "text"), meta)


@query(f"WITH {CHUNKS} SELECT doc_id, count(*) FILTER ({tokens('text')} > {HI}) AS n_oversize FROM c GROUP BY doc_id")
def oversize_report(spark, sf):
    return merging.oversize_report(conversation_chunks(spark, sf), HI)


@query(
    f"""WITH {CHUNKS} SELECT doc_id || '_' || pos AS id, text, CAST(doc_id AS VARCHAR) AS doi, title AS journal,
  CAST(page_number AS BIGINT) AS date FROM c"""
)
def index_schema_rows(spark, sf):
    """Rows ordered and cast to the schema registered for an index."""
    rows = conversation_chunks(spark, sf).select(
        F.concat_ws("_", "doc_id", "pos").alias("id"),
        F.col("page_number").alias("date"),
        F.col("doc_id").alias("doi"),
        F.col("title").alias("journal"),
        "text",
    )
    return records.index_rows(rows, "sci")
