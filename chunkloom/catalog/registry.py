"""Named queries over the benchmark tables, each with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE
from ..sources.readers import lines_to_elements, most_lines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def conversation_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of a conversation as the chunks of a document, two turns to a page."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").alias("doc_id"),
        F.col("turn").alias("pos"),
        F.col("role").alias("title"),
        "text",
        F.floor(F.col("turn") / 2).cast("int").alias("page_number"),
    )


def document_elements(spark: SparkSession, sf: str) -> DataFrame:
    return lines_to_elements(table(spark, sf, "documents").select("doc_id", "text"))


def longest_text(spark: SparkSession, sf: str) -> int:
    return most_lines(table(spark, sf, "documents"))


# SQL counterparts.
SPACE = "||".join(f"chr({ord(c)})" for c in WHITESPACE)

CHUNKS = """c AS (
  SELECT conv_id AS doc_id, turn AS pos, role AS title, text, CAST(turn // 2 AS INTEGER) AS page_number
  FROM conversations)"""

ELEMENTS = """e AS (
  SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos,
    CASE WHEN i = 1 OR (len(line) < 40 AND NOT ends_with(line, '.')) THEN 'Title' ELSE 'NarrativeText' END
      AS category, line AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"""


def tokens(text: str) -> str:
    """The estimate of ``functions.tokens``: two bytes that are not spaces make a token."""
    return f"((strlen({text}) - length({text}) + length(replace({text}, ' ', '')) + 1) // 2)"


def merged_sql(lo: int, hi: int, source: str = "c") -> str:
    """CTE ``m``: small chunks of ``source`` merged, without tables."""
    return f"""
s AS (SELECT *, {tokens('text')} AS n FROM {source}),
f AS (SELECT *, n BETWEEN {lo} AND {hi} AS is_mid FROM s),
g AS (SELECT *,
    coalesce(sum(CAST(is_mid AS INTEGER)) OVER w1, 0) AS grp,
    max(pos) OVER (PARTITION BY doc_id) AS last_pos,
    last_value(page_number) OVER w2 AS last_page
  FROM f
  WINDOW w1 AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         w2 AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
a AS (SELECT doc_id, grp,
    string_agg(CASE WHEN is_mid THEN text ELSE text || ' ' END, '' ORDER BY pos) AS text,
    bool_or(is_mid) AS closed, max(pos) AS last_in, max(page_number) FILTER (is_mid) AS mid_page,
    max(last_pos) AS last_pos, max(last_page) AS last_page
  FROM g WHERE n <= {hi} GROUP BY doc_id, grp),
m AS (SELECT doc_id, CASE WHEN closed THEN last_in ELSE last_pos + 1 END AS pos, 0 AS sub, text,
    CASE WHEN closed THEN mid_page ELSE last_page END AS page_number FROM a)"""
