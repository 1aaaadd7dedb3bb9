"""Queries on elements: the lines of a document, and fields that stand for pages and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import checks, filters, sections
from ..operators.segments import concat_ordered
from ..sources.markup import html_to_elements as to_elements
from .registry import CHUNKS, ELEMENTS, SPACE, conversation_chunks, document_elements, longest_text, query, table


@query(f"WITH {ELEMENTS} SELECT * FROM e")
def lines_to_elements(spark, sf):
    return document_elements(spark, sf).select("doc_id", "pos", "category", "text")


def packed_sql(under: int, soft: int, hard: int, elements: str = "e", table_rows: str = "false") -> str:
    """Sequential packing, one element of every document per step."""
    return f"""r AS (
  SELECT doc_id, pos, text, category = 'Title' AS is_title, {table_rows} AS is_table, len(text) AS n,
    ({table_rows}) OR len(text) > {hard} AS barrier,
    row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM {elements} WHERE len(trim(text, {SPACE})) > 0),
w AS (
  SELECT doc_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS fill, CAST(-1 AS BIGINT) AS chunk FROM r WHERE i = 1
  UNION ALL
  SELECT r.doc_id, r.i,
    CASE WHEN r.barrier THEN 0
      WHEN w.fill = 0 OR w.fill >= {soft} OR w.fill + 2 + r.n > {hard} OR (r.is_title AND w.fill >= {under}) THEN r.n
      ELSE w.fill + 2 + r.n END,
    CASE WHEN r.barrier THEN -1
      WHEN w.fill = 0 OR w.fill >= {soft} OR w.fill + 2 + r.n > {hard} OR (r.is_title AND w.fill >= {under}) THEN r.pos
      ELSE w.chunk END
  FROM w JOIN r ON r.doc_id = w.doc_id AND r.i = w.i + 1),
q AS (
  SELECT doc_id, pos, is_table, 0 AS sub, CAST(NULL AS VARCHAR) AS piece, text AS rest FROM r WHERE barrier
  UNION ALL
  SELECT doc_id, pos, is_table, sub + 1, substr(rest, 1, k), ltrim(substr(rest, k + 1), ' ')
  FROM (SELECT *, CASE WHEN len(rest) <= {hard} THEN len(rest)
      WHEN len(x) - instr(reverse(x), ' ') + 1 <= 1 OR instr(x, ' ') = 0 THEN {hard}
      ELSE len(x) - instr(reverse(x), ' ') END AS k
    FROM (SELECT *, substr(rest, 1, {hard + 1}) AS x FROM q) WHERE rest <> '')),
p AS (
  SELECT w.doc_id, w.chunk AS pos, 0 AS sub, 'Composite' AS kind,
    string_agg(r.text, chr(10) || chr(10) ORDER BY r.pos) AS text
  FROM w JOIN r ON r.doc_id = w.doc_id AND r.i = w.i WHERE NOT r.barrier GROUP BY w.doc_id, w.chunk
  UNION ALL
  SELECT doc_id, pos, sub - 1, CASE WHEN is_table THEN 'Table' ELSE 'Composite' END, piece FROM q
  WHERE piece IS NOT NULL)"""


_OUT = ("doc_id", "pos", "sub", "kind", "text")


@query(f"WITH RECURSIVE {ELEMENTS}, {packed_sql(100, 512, 4096)} SELECT * FROM p")
def chunk_by_title_pdf(spark, sf):
    return sections.chunk_by_title(document_elements(spark, sf), "pdf", longest=longest_text(spark, sf)).select(*_OUT)


@query(f"WITH RECURSIVE {ELEMENTS}, {packed_sql(0, 8192, 8192)} SELECT * FROM p")
def chunk_by_title_docx(spark, sf):
    return sections.chunk_by_title(document_elements(spark, sf), "docx", longest=longest_text(spark, sf)).select(*_OUT)


@query(f"WITH RECURSIVE {ELEMENTS}, {packed_sql(0, 4000, 4000)} SELECT * FROM p")
def chunk_by_title_docx_titled(spark, sf):
    return sections.chunk_by_title(document_elements(spark, sf), "docx_titled", longest=longest_text(spark, sf)).select(*_OUT)


@query(f"WITH RECURSIVE {ELEMENTS}, {packed_sql(0, 4096, 4096)} SELECT * FROM p")
def chunk_by_title_objects(spark, sf):
    return sections.chunk_by_title(document_elements(spark, sf), "objects", longest=longest_text(spark, sf)).select(*_OUT)


@query(f"WITH RECURSIVE {ELEMENTS}, {packed_sql(1000, 1000, 1000)} SELECT * FROM p")
def chunk_by_title_plain(spark, sf):
    return sections.chunk_by_title(document_elements(spark, sf), "docx_plain").select(*_OUT)


_TABLES = f"{ELEMENTS}, t AS (SELECT doc_id, pos, CASE WHEN ends_with(text, '?') THEN 'Table' ELSE category END AS category, text FROM e)"


@query(
    f"""WITH RECURSIVE {_TABLES}, {packed_sql(100, 512, 4096, 't', "category = 'Table'")} SELECT * FROM p"""
)
def chunk_by_title_tables(spark, sf):
    """Lines that end with a question mark stand for tables."""
    category = F.when(F.col("text").endswith("?"), F.lit("Table")).otherwise(F.col("category"))
    elements = document_elements(spark, sf).withColumn("category", category)
    return sections.chunk_by_title(elements, "sci_pdf").select(*_OUT)


@query(
    f"""WITH r AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i,
    unnest(string_split(text, chr(10))) AS line FROM documents),
t AS (SELECT doc_id, string_agg((i - 1) || ' ' || line, chr(10) ORDER BY i) AS rows FROM r GROUP BY doc_id)
SELECT doc_id, len('row line' || chr(10) || rows) > 4096 AS cut, true AS fits, true AS headed,
  translate('row line' || rows, {SPACE}, '') AS text, translate(rows, {SPACE}, '') AS cells FROM t"""
)
def chunk_by_title_long_tables(spark, sf):
    """The lines of a document as the rows of one table: all cells and all text, as found in the pieces."""
    blank = "".join(tx.WHITESPACE)

    def row(line, i):
        escaped = line
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
        return F.concat(F.lit("<tr><td>"), i.cast("string"), F.lit("</td><td>"), escaped, F.lit("</td></tr>"))

    lines = F.split("text", "\n")
    texts = F.transform(lines, lambda line, i: F.concat(i.cast("string"), F.lit(" "), line))
    elements = table(spark, sf, "documents").filter("text is not null").select(
        "doc_id", F.lit(0).cast("long").alias("pos"), F.lit("Table").alias("category"), F.lit(1).alias("page_number"),
        F.concat(F.lit("row line\n"), F.array_join(texts, "\n")).alias("text"),
        F.concat(F.lit("<table><tr><th>row</th><th>line</th></tr>"), F.array_join(F.transform(lines, row), ""), F.lit("</table>")).alias("html"),
    )
    pieces = sections.chunk_by_title(elements, "sci_pdf", longest=0)
    cells = F.array_join(F.regexp_extract_all("html", F.lit("<td>([^<]*)</td>"), F.lit(1)), "")
    cells = F.replace(F.replace(F.replace(cells, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))
    pieces = pieces.withColumns({"cells": F.translate(cells, blank, ""), "text_": F.translate("text", blank, "")})
    return pieces.groupBy("doc_id").agg(
        (F.count("*") > 1).alias("cut"),
        F.bool_and(F.length("text") <= 4096).alias("fits"),
        F.bool_and(F.coalesce(F.contains("html", F.lit("<tr><th>row</th><th>line</th></tr>")), F.lit(False))).alias("headed"),
        concat_ordered("text_", ["sub"]).alias("text"),
        concat_ordered("cells", ["sub"]).alias("cells"),
    )


_FURNITURE = "CASE WHEN starts_with(text, 'The ') THEN 'Header' WHEN len(text) < 60 THEN 'Footer' ELSE category END"


@query(f"WITH {ELEMENTS} SELECT doc_id, pos, text FROM e WHERE {_FURNITURE} NOT IN ('Header', 'Footer')")
def drop_page_furniture(spark, sf):
    category = (
        F.when(F.col("text").startswith("The "), F.lit("Header"))
        .when(F.length("text") < 60, F.lit("Footer"))
        .otherwise(F.col("category"))
    )
    elements = document_elements(spark, sf).withColumn("category", category)
    return filters.drop_page_furniture(elements).select("doc_id", "pos", "text")


@query(
    f"""WITH {ELEMENTS}, k AS (
  SELECT doc_id, pos, category, CASE WHEN category = 'Title' AND pos > 0 THEN ' Refer ences: ' || text ELSE text END AS text
  FROM e),
f AS (SELECT doc_id, min(pos) AS cut FROM k WHERE category = 'Title' AND regexp_matches(
    upper(translate(trim(text, {SPACE}), chr(32) || chr(10) || chr(9) || ':：', '')), '{"|".join(tx.BACK_MATTER)}')
  GROUP BY doc_id)
SELECT k.doc_id, pos, category, text FROM k LEFT JOIN f USING (doc_id) WHERE cut IS NULL OR pos < cut"""
)
def cut_back_matter(spark, sf):
    """Titles after the first are marked as the start of the references."""
    marked = (F.col("category") == "Title") & (F.col("pos") > 0)
    text = F.when(marked, F.concat(F.lit(" Refer ences: "), F.col("text"))).otherwise(F.col("text"))
    elements = document_elements(spark, sf).select("doc_id", "pos", "category", text.alias("text"))
    return filters.cut_back_matter(elements, longest=longest_text(spark, sf))


@query(
    f"""WITH {CHUNKS}, k AS (SELECT doc_id, pos,
    CASE WHEN len(text) > 900 THEN 'Online material' || chr(10) || text ELSE text END AS text FROM c),
f AS (SELECT doc_id, min(pos) AS cut FROM k
  WHERE regexp_matches(string_split(text, chr(10))[1], '{"|".join(tx.CHUNK_KEYWORDS)}') GROUP BY doc_id)
SELECT k.doc_id, pos, text FROM k LEFT JOIN f USING (doc_id) WHERE cut IS NULL OR pos < cut"""
)
def cut_chunks_at_keyword(spark, sf):
    text = F.when(F.length("text") > 900, F.concat(F.lit("Online material\n"), "text")).otherwise(F.col("text"))
    chunks = conversation_chunks(spark, sf).select("doc_id", "pos", text.alias("text"))
    return filters.cut_chunks_at_keyword(chunks)


@query(
    f"""WITH {ELEMENTS}, k AS (SELECT doc_id, pos, category, CASE
    WHEN category = 'Title' AND len(text) < 200 THEN 'Source'
    WHEN len(text) > 400 THEN 'Restriction of Use ' || text ELSE text END AS text FROM e),
b AS (SELECT *, max(CASE WHEN category = 'Title' AND text = 'Source' THEN pos END) OVER (PARTITION BY doc_id) AS a,
    max(CASE WHEN starts_with(text, 'Restriction of Use') THEN pos END) OVER (PARTITION BY doc_id) AS z FROM k),
s AS (SELECT doc_id, pos, category, text, count(*) OVER (PARTITION BY doc_id) AS n FROM b
  WHERE pos >= a AND (z IS NULL OR pos < z))
SELECT doc_id, pos, category, text FROM s WHERE n > 1"""
)
def slice_between_last(spark, sf):
    text = (
        F.when((F.col("category") == "Title") & (F.length("text") < 200), F.lit("Source"))
        .when(F.length("text") > 400, F.concat(F.lit("Restriction of Use "), "text"))
        .otherwise(F.col("text"))
    )
    elements = document_elements(spark, sf).select("doc_id", "pos", "category", text.alias("text"))
    return filters.slice_between_last(elements, longest=longest_text(spark, sf))


@query(
    """SELECT p_partkey AS doc_id FROM part
WHERE abs(p_size * 10.0 - 3) >= 250 AND abs(p_retailprice / 3 - 1) >= 270"""
)
def image_large_enough(spark, sf):
    def point(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    near = point(F.lit(3), F.lit(1))
    points = F.array(near, near, point(F.col("p_size") * 10, F.col("p_retailprice") / 3), near)
    parts = table(spark, sf, "part").filter(filters.image_large_enough(points))
    return parts.select(F.col("p_partkey").alias("doc_id"))


def _paged(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("pos"), F.col("p_size").alias("page_number")
    )


@query("SELECT p_brand AS doc_id, p_partkey AS pos, p_size AS page_number FROM part WHERE p_size <= 3")
def first_pages(spark, sf):
    return filters.page_subset(_paged(spark, sf), "first")


@query(
    """SELECT doc_id, pos, page_number FROM (
  SELECT p_brand AS doc_id, p_partkey AS pos, p_size AS page_number, max(p_size) OVER (PARTITION BY p_brand) AS pages
  FROM part) WHERE page_number <= 3 OR page_number > pages - 3"""
)
def first_and_last_pages(spark, sf):
    return filters.page_subset(_paged(spark, sf), "ends")


@query(
    """SELECT p_partkey AS doc_id, CASE WHEN p_size <= 7
    THEN array_to_string(range(0, p_size), ' ')
    ELSE array_to_string(list_sort(list_distinct(list_transform(range(0, 7),
      lambda i: CAST(floor(i * (p_size / 7.0)) AS INTEGER)))), ' ') END AS pages,
  array_to_string(range(0, least(p_size, 7)), ' ') AS leading FROM part"""
)
def sample_pages(spark, sf):
    total = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("doc_id"),
        F.array_join(filters.sample_pages(total, 7, "spread"), " ").alias("pages"),
        F.array_join(filters.sample_pages(total, 7, "firstN"), " ").alias("leading"),
    )


@query(
    f"""SELECT doc_id, replace(text, chr(65533), ' ') AS fixed, replace(replace(text, chr(10) || chr(10), ' '), chr(10), ' ')
  AS flat FROM (SELECT doc_id, replace(text, 'a', chr(65533)) AS text FROM documents)"""
)
def fix_utf8(spark, sf):
    """Replacement characters put in for one letter."""
    broken = F.replace(F.col("text"), F.lit("a"), F.lit("�"))
    docs = table(spark, sf, "documents").select("doc_id", broken.alias("text"))
    return docs.select(
        "doc_id", tx.fix_utf8(F.col("text")).alias("fixed"), tx.flatten_newlines(F.col("text")).alias("flat")
    )


@query(
    f"""WITH k AS (SELECT doc_id, replace(replace(text, '.' || chr(10), '.' || chr(10) || ' ' || chr(10)), '. ', '.  ') AS text
  FROM documents),
p AS (SELECT doc_id, regexp_replace(text, '[ \\t]*\\n[ \\t]*\\n\\s*', chr(1), 'g') AS text FROM k),
j AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\\s*\\n\\s*', ' ', 'g'), '[ \\t\\x{{a0}}]+', ' ', 'g'), {SPACE})
  AS text FROM p)
SELECT doc_id, replace(text, chr(1), chr(10) || chr(10)) AS text FROM j"""
)
def clean_text(spark, sf):
    """Blank lines and doubled spaces put in, then cleaned."""
    text = F.replace(F.replace(F.col("text"), F.lit(".\n"), F.lit(".\n \n")), F.lit(". "), F.lit(".  "))
    docs = table(spark, sf, "documents").select("doc_id", text.alias("text"))
    return docs.select("doc_id", tx.clean_text(F.col("text")).alias("text"))


@query(
    """WITH k AS (SELECT page_id, url, html, lower(html) AS l FROM pages),
v AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?is)<script\\b.*?</script>', '', 'g'), '(?is)<style\\b.*?</style>', '', 'g'), '(?is)<head\\b.*?</head>', '', 'g'),
    '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]*>', '', 'g'), """
    + SPACE
    + """) AS visible FROM k)
SELECT page_id, array_to_string(list_filter([
    CASE WHEN NOT contains(l, '<html') THEN 'unreadable' END,
    CASE WHEN NOT contains(l, '<body') THEN 'no pages' END,
    CASE WHEN visible = '' THEN 'no text on first page' END,
    CASE WHEN contains(l, '<html') AND NOT contains(l, '</html>') THEN 'damaged structure' END],
    lambda x: x IS NOT NULL), '|') AS issues,
  array_to_string(list_filter([
    CASE WHEN len(regexp_extract(l, '(?s)<h1[^>]*>(.*?)</h1>', 1)) > 0 THEN 'has heading' END,
    CASE WHEN contains(l, '<table') THEN 'has table' END], lambda x: x IS NOT NULL), '|') AS info,
  CAST(strlen(html) AS BIGINT) AS size
FROM v"""
)
def prescreen(spark, sf):
    found = checks.prescreen(table(spark, sf, "pages"))
    return found.select(
        "page_id", F.array_join("issues", "|").alias("issues"), F.array_join("info", "|").alias("info"), "size"
    )


# Markup of the given pages: block tags become marks, the rest goes, the last block opened names the text.
@query(
    """WITH k AS (SELECT page_id AS doc_id, regexp_replace(regexp_replace(html, '(?is)<head\\b.*?</head>', '', 'g'),
    '(?s)<!.*?>', '', 'g') AS h FROM pages),
b AS (SELECT doc_id, regexp_replace(regexp_replace(h, '(?i)<(/?(nav|ul|li|div|article|h1|p|br|footer|body|html))\\b[^>]*>',
    chr(1) || '\\1' || chr(2), 'g'), '<[^>]*>', '', 'g') AS h FROM k),
s AS (SELECT doc_id, unnest(string_split(h, chr(1))) AS piece, generate_subscripts(string_split(h, chr(1)), 1) AS i FROM b),
t AS (SELECT doc_id, i, string_split(piece, chr(2))[1] AS tag,
    trim(regexp_replace(string_split(piece, chr(2))[2], '\\s+', ' ', 'g')) AS raw FROM s WHERE i > 1),
c AS (SELECT *, last_value(CASE WHEN tag NOT LIKE '/%' AND tag <> 'br' THEN tag END IGNORE NULLS) OVER
    (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block FROM t)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos,
  CASE block WHEN 'li' THEN 'Header' WHEN 'h1' THEN 'Title' WHEN 'p' THEN 'NarrativeText' WHEN 'footer' THEN 'Footer'
    ELSE 'Text' END AS category,
  regexp_replace(replace(replace(replace(raw, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') AS text,
  CAST(1 AS INTEGER) AS page_number, NULL::VARCHAR AS html
FROM c WHERE raw <> ''"""
)
def html_to_elements(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "html")
    return to_elements(pages)
