"""Title-led chunking of elements and heading-led grouping."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .segments import BLOCK_ROWS, Running, concat_ordered, scan
from .tables import cut_table


@dataclass(frozen=True)
class Profile:
    combine_under: int
    new_after: int | None
    max_chars: int

    @property
    def soft(self) -> int:
        return min(self.new_after or self.max_chars, self.max_chars)


# Chunk sizes per kind of source, in characters.
PROFILES = {
    "pdf": Profile(100, 512, 4096),
    "sci_pdf": Profile(100, 512, 4096),
    "docx": Profile(0, None, 8192),
    "docx_titled": Profile(0, None, 4000),
    "objects": Profile(0, None, 4096),
    "docx_plain": Profile(1000, 1000, 1000),
}

SEP = "\n\n"


def _transfer(n, title, barrier, pos, profile: Profile):
    """How a block of elements maps the length of the open chunk on entry to the state on exit.

    All entry lengths are followed at once; equal states are merged as they meet. Returns runs
    ``(low, shift, value, start)``: entry lengths from ``low`` on leave with ``value`` (plus the entry
    length when ``shift``) in a chunk that began at ``start`` (-1: before this block).
    """
    entry = np.arange(profile.soft)
    length, start = entry.copy(), np.full(profile.soft, -1)
    slot = entry.copy()
    for i in range(len(n)):
        if barrier[i]:
            length, start, slot = np.zeros(1, int), np.full(1, -1), np.zeros_like(slot)
        if len(length) == 1:
            # All entry lengths have met; from here on there is one state to follow.
            state = _pack_lengths(
                int(length[0]), int(start[0]), n[i:].tolist(), title[i:].tolist(), barrier[i:].tolist(),
                pos[i:].tolist(), profile,
            )
            length, start = np.array([state[0]]), np.array([state[1]])
            break
        fresh = (length == 0) | (length + len(SEP) + n[i] > profile.max_chars)
        if title[i]:
            fresh |= length >= profile.combine_under
        length = np.where(fresh, n[i], length + len(SEP) + n[i])
        start = np.where(fresh, pos[i], start)
        closed = length >= profile.soft
        length, start = np.where(closed, 0, length), np.where(closed, -1, start)
        if i % 16 == 0:
            states, back = np.unique(np.stack([length, start]), axis=1, return_inverse=True)
            length, start, slot = states[0], states[1], np.asarray(back).reshape(-1)[slot]
    runs = []
    for low in range(profile.soft):
        out, began = int(length[slot[low]]), int(start[slot[low]])
        shift = began == -1 and out > 0
        run = (bool(shift), out - low if shift else out, began)
        if not runs or runs[-1][1:] != run:
            runs.append((low, *run))
    return runs


def _pack_lengths(length, start, n, title, barrier, pos, profile: Profile) -> tuple[int, int]:
    """State after packing elements one after the other."""
    soft, hard, under = profile.soft, profile.max_chars, profile.combine_under
    for size, is_title, is_barrier, at in zip(n, title, barrier, pos):
        if is_barrier:
            length, start = 0, -1
            continue
        if length == 0 or length + len(SEP) + size > hard or (is_title and length >= under):
            length, start = size, at
        else:
            length += len(SEP) + size
        if length >= soft:
            length, start = 0, -1
    return length, start


def _follow(runs, length: int, start: int) -> tuple[int, int]:
    """State on exit for one state on entry."""
    low, shift, value, began = next(r for r in reversed(runs) if r[0] <= length)
    if shift:
        return length + value, start if length else began
    return value, began


def _compose(first, second):
    """Runs of two neighbouring stretches taken together."""
    out = []

    def add(low, shift, value, began):
        if not out or out[-1][1:] != (shift, value, began):
            out.append((low, shift, value, began))

    for k, (low, shift, value, began) in enumerate(first):
        if not shift:
            add(low, False, *_follow(second, value, began))
            continue
        high = first[k + 1][0] if k + 1 < len(first) else None
        for m, (low2, shift2, value2, began2) in enumerate(second):
            high2 = second[m + 1][0] if m + 1 < len(second) else None
            begin = max(low, low2 - value)
            if (high is None or begin < high) and (high2 is None or begin + value < high2):
                add(begin, shift2, value + value2 if shift2 else value2, began2)
    return out


# Blocks chained in one group; longer documents are chained over groups of blocks.
CHAIN = 1000


def _entries_of_blocks(elements: DataFrame, profile: Profile, chain: int | None = None) -> DataFrame:
    """``doc_id, _blk, _open, _from``: state on entry to every block but the first of a long document.

    Maps compose, so even a document of millions of blocks never meets in one task: groups of blocks
    are composed in parallel, only the groups are chained, and each group is then chained from its
    own entry state.
    """
    n = F.length("text")
    narrow = elements.select(
        "doc_id", "_blk", "pos", n.alias("_n"), "_title",
        (F.col("_table") | (n > profile.max_chars)).alias("_barrier"),
    )
    long_docs = (
        narrow.groupBy("doc_id")
        .agg(F.min("_blk").alias("_b0"), F.max("_blk").alias("_b1"))
        .filter("_b1 > _b0")
    )
    doc_type = elements.schema["doc_id"].dataType.simpleString()
    maps = f"doc_id {doc_type}, at_ long, low array<int>, shift array<boolean>, value array<int>, began array<long>"
    entries = f"doc_id {doc_type}, at_ long, _open int, _from long"

    def as_row(doc, at, runs):
        low, shift, value, began = (list(c) for c in zip(*runs))
        return pd.DataFrame(
            {"doc_id": [doc], "at_": [at], "low": [low], "shift": [shift], "value": [value], "began": [began]}
        )

    def runs_of(row):
        return list(zip(row.low, row.shift, row.value, row.began))

    def summarise(keys, block):
        block = block.sort_values("pos")
        columns = (block[c].to_numpy() for c in ("_n", "_title", "_barrier", "pos"))
        return as_row(keys[0], keys[1], _transfer(*columns, profile))

    def compose(keys, blocks):
        runs = None
        for row in blocks.sort_values("at_").itertuples(index=False):
            runs = runs_of(row) if runs is None else _compose(runs, runs_of(row))
        return as_row(keys[0], keys[1], runs)

    def follow(keys, blocks):
        ordered = blocks.sort_values("at_")
        length, start = 0, -1
        if "_open" in ordered.columns:
            length, start = int(ordered["_open"].iloc[0]), int(ordered["_from"].iloc[0])
        out = []
        for row in ordered.itertuples(index=False):
            out.append((row.doc_id, row.at_, length, start))
            length, start = _follow(runs_of(row), length, start)
        return pd.DataFrame(out, columns=["doc_id", "at_", "_open", "_from"])

    blocks = narrow.join(long_docs.select("doc_id"), "doc_id").groupBy("doc_id", "_blk")
    blocks = blocks.applyInPandas(summarise, maps)
    group = F.expr(f"at_ div {chain or CHAIN}")
    groups = blocks.groupBy("doc_id", group.alias("_grp")).applyInPandas(compose, maps)
    starts = groups.groupBy("doc_id").applyInPandas(follow, entries)
    placed = blocks.withColumn("_grp", group).join(starts.withColumnRenamed("at_", "_grp"), ["doc_id", "_grp"])
    found = placed.groupBy("doc_id", "_grp").applyInPandas(follow, entries)
    return found.withColumnRenamed("at_", "_blk")


def _cut(text: str, limit: int) -> list[str]:
    """Pieces of at most ``limit`` characters, cut at the last space that allows it."""
    pieces = []
    while len(text) > limit:
        space = text.rfind(" ", 1, limit + 1)
        end = space if space > 0 else limit
        pieces.append(text[:end])
        text = text[end:].lstrip(" ")
    return pieces + [text] if text else pieces


_PACKED = ["doc_id", "_blk", "pos", "sub", "kind", "text", "page_number", "html"]


def _pack(profile: Profile):
    """Task function: streams over sorted elements and writes chunks as they close.

    A chunk that is still open at the end of a block, or was open at its start, comes out in parts that
    share its first position.
    """
    soft, hard, under = profile.soft, profile.max_chars, profile.combine_under
    columns = ["doc_id", "_blk", "pos", "text", "page_number", "html", "_title", "_table", "_open", "_from"]

    def frame(rows):
        return pd.DataFrame(rows, columns=_PACKED).astype({"page_number": "Int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, length, start, texts, page, out = None, 0, -1, [], None, []

        def close():
            if texts:
                out.append((*at, start, 0, "Composite", SEP.join(texts), page, None))
                texts.clear()

        for batch in batches:
            for doc, blk, pos, text, number, html, title, table, entry, began in zip(
                *(batch[c] for c in columns)
            ):
                if at != (doc, blk):
                    close()
                    at, length, start, page = (doc, blk), 0, -1, number
                if pos < 0:
                    length, start = int(entry), int(began)
                    page = None
                    continue
                if page is None:
                    page = number
                n = len(text)
                if table or n > hard:
                    close()
                    length, start = 0, -1
                    kind = "Table" if table else "Composite"
                    if n <= hard:
                        pieces = [(text, html)]
                    elif table:
                        pieces = cut_table(text, html, hard, _cut)
                    else:
                        pieces = [(p, None) for p in _cut(text, hard)]
                    out.extend((doc, blk, pos, i, kind, p, number, own) for i, (p, own) in enumerate(pieces))
                    continue
                if length == 0 or length + len(SEP) + n > hard or (title and length >= under):
                    close()
                    length, start, page = n, pos, number
                else:
                    length += len(SEP) + n
                texts.append(text)
                if length >= soft:
                    close()
                    length, start = 0, -1
            yield frame(out)
            out = []
        close()
        yield frame(out)

    return run


def chunk_by_title(
    elements: DataFrame,
    profile: Profile | str = "pdf",
    block_rows: int = BLOCK_ROWS,
    longest: int | None = None,
) -> DataFrame:
    """Pack elements into chunks led by titles.

    Input ``doc_id, pos, category, text, page_number, html``; output ``doc_id, pos, sub, kind, text,
    page_number, html`` with kind ``Composite`` or ``Table``. The elements of a chunk are joined by a
    blank line. An open chunk closes when it has reached ``new_after`` characters, when the next
    element would take it beyond ``max_chars``, or when a title comes and it has ``combine_under``
    characters. Tables stand alone; an element longer than ``max_chars`` is cut at spaces, a table with
    markup between rows, each piece with markup of its own and the header repeated.

    Packing depends on everything before it in the document, yet no task gets a whole document: the
    length of the open chunk is the only state, so each block of elements is first summarised as a map
    from entry to exit length, the maps are chained, and the blocks are then packed independently.
    With ``longest`` (the largest position) showing that no document needs a second block, one shuffle
    and one pass are all there is.
    """
    profile = PROFILES[profile] if isinstance(profile, str) else profile
    one_block = longest is not None and longest < block_rows
    rows = elements.filter(~tx.is_blank(F.col("text"))).select(
        "doc_id",
        "pos",
        "text",
        F.col("page_number").cast("int").alias("page_number"),
        "html",
        (F.lit(0).cast("long") if one_block else F.expr(f"pos div {block_rows}")).alias("_blk"),
        (F.col("category") == "Title").alias("_title"),
        (F.col("category") == "Table").alias("_table"),
    )
    placed = rows.withColumns({"_open": F.lit(None).cast("int"), "_from": F.lit(None).cast("long")})
    if not one_block:
        # The entry state comes as a row of its own that sorts before the block. A join in its place
        # would have to be followed by a shuffle that the optimizer may drop as already done and then
        # undo by reading the join's own shuffle locally.
        entries = _entries_of_blocks(rows, profile).withColumn("pos", F.lit(-1).cast("long"))
        placed = placed.unionByName(entries, allowMissingColumns=True)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kinds |= {"sub": "int", "kind": "string"}
    packed = (
        placed.repartition(F.xxhash64("doc_id", "_blk"))
        .sortWithinPartitions("doc_id", "_blk", "pos")
        .mapInPandas(_pack(profile), ", ".join(f"{c} {kinds[c]}" for c in _PACKED))
    )
    if one_block:
        return packed.drop("_blk")
    # Parts of a chunk that spans blocks are joined; all other groups have one row.
    joined = packed.groupBy("doc_id", "pos", "sub", "kind").agg(
        concat_ordered("text", ["_blk"], SEP).alias("text"),
        F.min_by("page_number", "_blk").alias("page_number"),
        F.max("html").alias("html"),
    )
    return joined.select(*[c for c in _PACKED if c != "_blk"])


def heading_sections(paragraphs: DataFrame, longest: int | None = None) -> DataFrame:
    """Body under each heading: ``doc_id, pos, heading, body``.

    Input ``doc_id, pos, is_heading, text``. Text before the first heading and under an empty heading
    is dropped; a heading that comes again keeps its first place and its last body.
    """
    grouped = scan(paragraphs, "doc_id", "pos", {"_grp": Running("count", F.col("is_heading"))}, longest=longest)
    body = F.when(~F.col("is_heading"), F.col("text"))
    sections = (
        grouped.filter("_grp > 0")
        .withColumn("_body", body)
        .groupBy("doc_id", "_grp")
        .agg(
            F.max(F.when(F.col("is_heading"), F.col("text"))).alias("heading"),
            F.min("pos").alias("pos"),
            concat_ordered("_body", ["pos"], "\n").alias("body"),
        )
        .filter("heading != ''")
    )
    return (
        sections.groupBy("doc_id", "heading")
        .agg(F.min("pos").alias("_first"), F.max_by("body", "pos").alias("body"))
        .select("doc_id", F.col("_first").alias("pos"), "heading", "body")
    )


def slide_text(shapes: DataFrame, with_page: bool = False) -> DataFrame:
    """Text of each slide: shapes, then notes, then recognised elements; ``title`` is its first line.

    Input ``doc_id, slide, pos, part, text`` with part ``shape``, ``note`` or ``element``.
    """

    def part(name: str, sep: str):
        rows = F.sort_array(F.collect_list(F.when(F.col("part") == name, F.struct("pos", "text"))))
        return F.array_join(F.transform(rows, lambda r: r["text"]), sep)

    joined = shapes.groupBy("doc_id", "slide").agg(
        part("shape", " ").alias("_s"), part("note", " ").alias("_n"), part("element", " ").alias("_e")
    )
    text = F.concat_ws("\n\n", tx.strip(F.col("_s")), tx.strip(F.col("_n")), F.col("_e"))
    joined = joined.withColumn("text", text)
    if with_page:
        joined = joined.withColumn(
            "text", F.concat(F.lit("Page: "), F.col("slide").cast("string"), F.lit("\n"), F.col("text"))
        )
    return joined.select("doc_id", "slide", tx.first_line(F.col("text")).alias("title"), "text")
