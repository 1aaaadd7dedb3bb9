"""Operators on the ordered chunks of a document: merge, group, fold tails, number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.tokens import Counter, token_estimate
from .segments import Running, Whole, concat_ordered, number_rows, scan
from .tables import tables_of

LOW, HIGH = 15, 8100


def merge_small_chunks(
    chunks: DataFrame,
    lo: int = LOW,
    hi: int = HIGH,
    counter: Counter = token_estimate,
    label: str = "page_number",
    tables: bool = True,
    keep_text: bool = False,
    meta: DataFrame | None = None,
    longest: int | None = None,
) -> DataFrame:
    """Prefix short chunks to the next chunk of ordinary size.

    Input ``doc_id, pos, text, <label>``, and ``n_tokens`` if it was counted before. Output
    ``doc_id, pos, sub, idx, text, <label>`` and the columns of ``meta`` (one row per document, inner
    join); ``idx`` counts the output of a document from zero.

    A chunk shorter than ``lo`` waits (with one space) for the next chunk of ``lo..hi`` tokens, whose
    label the merged chunk takes. A chunk longer than ``hi`` is replaced at its place by the tables in
    it, each cut to size; its other text is dropped unless ``keep_text``. What still waits at the end
    forms a last chunk labelled like the last row of the document.
    """
    n_tokens = F.col("n_tokens") if "n_tokens" in chunks.columns else counter(F.col("text"))
    sized = chunks.withColumn("text", F.coalesce("text", F.lit("")))
    sized = sized.select("doc_id", "pos", "text", label, n_tokens.alias("_n"))
    sized = sized.withColumns(
        {"_big": F.col("_n") > hi, "_mid": (F.col("_n") >= lo) & (F.col("_n") <= hi)}
    )
    if keep_text:
        parts = F.when(F.col("_big"), F.array("text"))
    elif tables:
        # Only oversize chunks with table markup hand their text to Python; all others hand over null.
        marked = F.col("_big") & F.contains(F.lower("text"), F.lit("<table"))
        parts = tables_of(F.when(marked, F.col("text")), hi, counter)
    else:
        parts = F.lit(None).cast("array<string>")
    sized = sized.withColumn("_parts", parts)
    n_parts = F.coalesce(F.array_size("_parts"), F.lit(0)).cast("long")
    sized = sized.withColumn("text", F.when(~F.col("_big"), F.col("text")))
    flagged = scan(
        sized,
        "doc_id",
        "pos",
        {
            "_grp": Running("count", F.col("_mid"), inclusive=False),
            "_tab": Running("sum", n_parts, inclusive=False),
            "_n_grp": Whole("count", F.col("_mid")),
            "_n_tab": Whole("sum", n_parts),
            "_last_pos": Whole("max", F.col("pos")),
            "_last_label": Whole("at_end", F.col(label)),
        },
        attach=meta,
        longest=longest,
    )
    before = F.col("_grp") + F.coalesce("_tab", F.lit(0))
    piece = F.when(F.col("_mid"), F.col("text")).otherwise(F.concat("text", F.lit(" ")))
    items = F.when(F.col("_big"), F.col("_parts")).otherwise(F.array(piece))
    details = [c for c in meta.columns if c != "doc_id"] if meta is not None else []
    pieces = flagged.withColumn("_at", before).select(
        "doc_id", "pos", label, "_big", "_mid", "_at", "_n_grp", "_n_tab", "_last_pos", "_last_label",
        F.when(~F.col("_big"), F.col("_grp")).alias("_grp"),
        F.when(F.col("_big"), F.col("pos")).alias("_own"),
        # The outer form keeps the optimizer from evaluating the tables once more to test for none.
        F.posexplode_outer(items).alias("sub", "_piece"),
        *details,
    ).filter("_piece is not null")
    # Metadata columns depend on the document, as grouping columns they cost no aggregate.
    closing = F.col("_mid") | F.col("_big")
    merged = pieces.groupBy("doc_id", "_grp", "_own", "sub", *details).agg(
        concat_ordered("_piece", ["pos"]).alias("text"),
        F.max(F.when(closing, F.col("pos"))).alias("_end"),
        F.max(F.when(closing, F.col(label))).alias("_label"),
        F.max(F.when(closing, F.col("_at"))).alias("_at"),
        F.max("_last_pos").alias("_last_pos"),
        F.max("_last_label").alias("_last_label"),
        F.max(F.col("_n_grp") + F.coalesce("_n_tab", F.lit(0))).alias("_n_before_tail"),
    )
    closed = F.col("_end").isNotNull()
    return merged.select(
        "doc_id",
        F.when(closed, F.col("_end")).otherwise(F.col("_last_pos") + 1).alias("pos"),
        "sub",
        F.when(closed, F.col("_at") + F.col("sub")).otherwise(F.col("_n_before_tail")).alias("idx"),
        "text",
        F.when(closed, F.col("_label")).otherwise(F.col("_last_label")).alias(label),
        *details,
    )


def chunk_id() -> Column:
    return F.concat_ws("_", F.col("doc_id").cast("string"), F.col("idx").cast("string"))


def oversize_report(chunks: DataFrame, hi: int = HIGH, counter: Counter = token_estimate) -> DataFrame:
    """Chunks per document whose plain text a merge would drop."""
    return chunks.groupBy("doc_id").agg(F.count_if(counter(F.col("text")) > hi).alias("n_oversize"))


def attach_tables(rows: DataFrame, sep: str = "\n", null_html: str = "text", longest: int | None = None) -> DataFrame:
    """Append each table to the text row before it.

    Input ``doc_id, pos, kind, text, html, page_number``; a row of kind ``Table`` joins the previous row
    and takes over its page, anything else starts a row. Tables before the first text row form one row.
    ``null_html``: ``text`` falls back to the table's text, ``skip`` leaves such tables out, ``both``
    writes text and html. Rows of one position are taken in the order of ``sub``, if there is one.
    """
    ties = ["sub"] if "sub" in rows.columns else []
    is_table = F.col("kind") == "Table"
    if null_html == "skip":
        rows = rows.filter(~is_table | F.col("html").isNotNull())
    if null_html == "both":
        table_text = F.concat_ws("\n\n", "text", "html")
    else:
        table_text = F.coalesce(F.col("html"), F.col("text"))
    grouped = scan(
        rows.withColumn("_piece", F.when(is_table, table_text).otherwise(F.col("text"))),
        "doc_id",
        "pos",
        {"_grp": Running("count", ~is_table)}, tuple(ties), longest=longest)
    return (
        grouped.groupBy("doc_id", "_grp")
        .agg(
            F.min("pos").alias("pos"),
            concat_ordered("_piece", ["pos", *ties], sep).alias("text"),
            F.min_by("page_number", "pos").alias("page_number"),
        )
        .select("doc_id", "pos", "text", "page_number")
    )


def merge_title_blocks(chunks: DataFrame, longest: int | None = None) -> DataFrame:
    """Put runs of title lines in front of the body that follows; trailing titles end the last body."""
    is_title = tx.is_title_line(F.col("text"))
    grouped = scan(
        chunks.select("doc_id", "pos", "text").withColumn("_title", is_title),
        "doc_id",
        "pos",
        {
            "_grp": Running("count", ~F.col("_title"), inclusive=False),
            "_bodies": Whole("count", ~F.col("_title")),
        }, longest=longest)
    # Group g holds the titles before body g and body g itself; the group after the last body has
    # titles only and goes to the last body, if there is one.
    home = F.when(
        (F.col("_grp") == F.col("_bodies")) & (F.col("_bodies") > 0), F.col("_grp") - 1
    ).otherwise(F.col("_grp"))
    return (
        grouped.withColumn("_piece", F.when(F.col("_title"), tx.strip(F.col("text"))).otherwise(F.col("text")))
        .groupBy("doc_id", home.alias("_home"))
        .agg(F.min("pos").alias("pos"), concat_ordered("_piece", ["pos"], "\n").alias("text"))
        .select("doc_id", "pos", "text")
    )


def absorb_short_tail(chunks: DataFrame, below: int = 10, longest: int | None = None) -> DataFrame:
    """Append a last chunk of fewer than ``below`` characters to the chunk before it."""
    short = F.length("text") < below
    marked = scan(
        chunks,
        "doc_id",
        "pos",
        {
            "_i": Running("count", F.lit(True)),
            "_n": Whole("count", F.lit(True)),
            "_tail": Whole("at_end", F.when(short, F.col("text"))),
        }, longest=longest)
    folds = (F.col("_n") >= 2) & F.col("_tail").isNotNull()
    return (
        marked.filter(~(folds & (F.col("_i") == F.col("_n"))))
        .withColumn(
            "text",
            F.when(folds & (F.col("_i") == F.col("_n") - 1), F.concat_ws(" ", "text", "_tail")).otherwise(
                F.col("text")
            ),
        )
        .select(*chunks.columns)
    )


def assign_chunk_ids(
    chunks: DataFrame,
    ties: tuple[str, ...] = ("sub",),
    meta: DataFrame | None = None,
    longest: int | None = None,
) -> DataFrame:
    """Add ``idx`` (from zero, in output order) and ``chunk_id`` = ``<doc>_<idx>``.

    With ``meta`` (one row per document) the metadata join rides on the same shuffle; chunks without
    metadata are left out.
    """
    present = tuple(t for t in ties if t in chunks.columns)
    numbered = number_rows(chunks, "doc_id", "pos", "idx", present, attach=meta, longest=longest)
    return numbered.withColumn("chunk_id", chunk_id())


def skip_blank_keep_index(records: DataFrame, longest: int | None = None) -> DataFrame:
    """Number first, then drop blank texts, so that the ids keep their gaps."""
    return assign_chunk_ids(records, longest=longest).filter(~tx.is_blank(F.col("text")))


def fixed_groups(chunks: DataFrame, size: int = 10, longest: int | None = None) -> DataFrame:
    """Consecutive groups of ``size`` chunks joined by a space; an incomplete last group is dropped."""
    numbered = number_rows(chunks.select("doc_id", "pos", "text"), "doc_id", "pos", longest=longest)
    return (
        numbered.groupBy("doc_id", F.floor(F.col("idx") / size).alias("grp"))
        .agg(concat_ordered("text", ["pos"], " ").alias("text"), F.count("*").alias("_n"))
        .filter(F.col("_n") == size)
        .select("doc_id", "grp", "text")
    )


def title_content(chunks: DataFrame, policy: str = "plain", longest: int | None = None) -> DataFrame:
    """``title`` and ``content`` of each chunk; ``carry`` re-uses the latest title of the document."""
    if policy == "carry":
        heads = chunks.withColumn("_head", tx.split_title(F.col("text"), "drop").getField("title"))
        carried = scan(heads, "doc_id", "pos", {"title": Running("last", F.col("_head"))}, longest=longest)
        return carried.withColumn("content", F.col("text")).drop("_head")
    pair = chunks.withColumn("_pair", tx.split_title(F.col("text"), policy))
    if policy == "drop":
        pair = pair.filter(F.col("_pair").isNotNull())
    kept = [c for c in chunks.columns if c not in ("title", "content")]
    return pair.select(*kept, "_pair.title", "_pair.content")


def latest_per_key(log: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Last write per key. ``max_by`` combines before the shuffle, so a hot key stays cheap."""
    payload = [c for c in log.columns if c not in keys]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}") for c in payload])
    )


def document_text(chunks: DataFrame, with_pages: str | None = None) -> Column:
    """Text of one chunk in the plain-text rendering of a document."""
    if with_pages is None:
        return F.col("text")
    page = F.col("page_number").cast("string")
    if with_pages == "page":
        return F.concat(F.lit("Page "), page, F.lit(": "), F.col("text"))
    return F.concat(F.lit("Page "), page, F.lit(":\n"), F.col("title"), F.lit("\n"), F.col("content"))


def render_text(chunks: DataFrame, with_pages: str | None = None, part_chunks: int = 10_000, longest: int | None = None) -> DataFrame:
    """Plain text of each document, chunks parted by a dashed line.

    A document of more than ``part_chunks`` positions comes out in several parts; the file is the parts
    in order, nothing is added between them.
    """
    first = scan(
        chunks.withColumn("_body", document_text(chunks, with_pages)),
        "doc_id",
        "pos",
        {"_first": Whole("min", F.col("pos"))}, longest=longest)
    piece = F.when(F.col("pos") == F.col("_first"), F.col("_body")).otherwise(
        F.concat(F.lit("\n----------\n"), F.col("_body"))
    )
    return (
        first.withColumn("_piece", piece)
        .groupBy("doc_id", F.floor(F.col("pos") / part_chunks).alias("part"))
        .agg(concat_ordered("_piece", ["pos"]).alias("text"))
    )
