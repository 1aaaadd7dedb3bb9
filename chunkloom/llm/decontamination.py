"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of ``n`` consecutive words of the items. The alphabet is words: a block is the last two
words of a window, a table indexed by the block's hash says how far a search may move on (as far as the whole
window less one word where no pattern holds the block), blocks that end a pattern lead to a bucket of patterns,
and the words themselves are then compared. Many cursors move through a chunk of text at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KEY, LOWER, chunks, row_key, text_bytes, with_columns_renamed, words_of, written

WINDOW = 13
ITEM_BYTES = 4 << 20  # of item texts in one broadcast set of tables
SEGMENT = 256
TABLE_BITS = 20

IN_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
# Lower-cases A-Z and turns what separates words into a space.
CLEAN = bytes(LOWER[b] if IN_WORD[LOWER[b]] else 32 for b in range(256))


class Tables:
    """Shift table and suffix buckets of all patterns with the same number of words."""

    def __init__(self, size: int, patterns: dict[bytes, int]):
        self.size, self.block = size, min(2, size)
        self.shift = np.full(1 << TABLE_BITS, size - self.block + 1, np.uint8)
        self.buckets: dict[int, dict[bytes, int]] = {}
        keys = list(patterns)
        _, _, _, hashes, first = words_of(keys)
        for j in range(self.block, size + 1):
            at = first[:-1] + j - 1
            np.minimum.at(self.shift, self.blocks(hashes, at), size - j)
        for key, code in zip(keys, self.blocks(hashes, first[:-1] + size - 1).tolist()):
            self.buckets.setdefault(code, {})[key] = patterns[key]

    def blocks(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Table index of the block that ends at each word."""
        with np.errstate(over="ignore"):
            x = hashes[at]
            if self.block == 2:
                x = x + hashes[at - 1] * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words, and their blocks, of the places that the shift table does not rule out."""
        begin, stop = first[:-1] + self.size - 1, first[1:]
        parts = np.maximum(0, -(-(stop - begin) // SEGMENT))
        offset = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at = np.repeat(begin, parts) + offset * SEGMENT
        end = np.minimum(at + SEGMENT, np.repeat(stop, parts))
        found, codes = [], []
        while len(at):
            block = self.blocks(hashes, at)
            step = self.shift[block]
            hit = step == 0
            found.append(at[hit])
            codes.append(block[hit])
            at = at + np.maximum(step, 1)
            going = at < end
            at, end = at[going], end[going]
        return (np.concatenate(found), np.concatenate(codes)) if found else (np.zeros(0, int),) * 2


def tables_of(items: list[tuple[str, str]], n: int) -> tuple[list[Tables], list[list[str]]]:
    """Tables for each window length, and the ids of the items that hold each pattern."""
    by_size: dict[int, dict[bytes, int]] = {}
    owners: list[list[str]] = []
    for item, text in items:
        words = text.encode().translate(CLEAN).split()
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            known = by_size.setdefault(size, {})
            code = known.setdefault(b" ".join(words[i : i + size]), len(owners))
            if code == len(owners):
                owners.append([])
            if item not in owners[code][-1:]:
                owners[code].append(item)
    return [Tables(size, patterns) for size, patterns in sorted(by_size.items())], owners


def search(texts: list[bytes], tables: list[Tables], owners: list[list[str]]):
    """For each text: number of words, starts and ends of the runs of hit words, and items found."""
    joined, starts, ends, hashes, first = words_of([t.translate(CLEAN) for t in texts], IN_WORD)
    items: list[set[str]] = [set() for _ in texts]
    hits = []
    for t in tables:
        at, codes = t.candidates(hashes, first)
        docs = np.searchsorted(first, at, side="right") - 1
        for last, code, doc in zip(at.tolist(), codes.tolist(), docs.tolist()):
            begin = last - t.size + 1
            words = joined[starts[begin] : ends[last]]
            pattern = t.buckets.get(code, {}).get(words)
            if pattern is None and (b"  " in words or b"\n" in words):
                pattern = t.buckets.get(code, {}).get(b" ".join(words.split()))
            if pattern is not None:
                items[doc].update(owners[pattern])
                hits.append((begin, last + 1))
    covered = np.zeros(len(starts) + 1, np.int32)
    if hits:
        h = np.array(hits)
        np.add.at(covered, h[:, 0], 1)
        np.add.at(covered, h[:, 1], -1)
    covered = (np.cumsum(covered) > 0)[:-1]
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        runs_from, runs_to = [], []
        if items[i]:
            step = np.diff(np.concatenate([[0], covered[a:b].astype(np.int8), [0]]))
            runs_from, runs_to = np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()
        yield b - a, runs_from, runs_to, sorted(items[i])


SCHEMA = (
    "doc_id long, k1 long, k2 long, n_words long, begins array<int>, ends array<int>, items array<string>"
)


def decontaminate(docs: DataFrame, items: DataFrame, n: int = WINDOW, percent: int = 5) -> DataFrame:
    """doc_id, k1, k2, n_words, n_hit, n_items, items, contaminated for every document.

    Items are searched in blocks of at most ITEM_BYTES of text, which bounds what is broadcast; the hits of the
    blocks are put together per document. Null texts have no words, items without id or words have no windows,
    repeated items count once per id, repeated documents are judged each; an empty table of items hits nothing.
    Further columns are ignored. A document is contaminated if hit words are ``percent`` % of its words or more.
    """
    rows = with_columns_renamed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text")
    known = with_columns_renamed(items, "item_id", "text").where("item_id is not null and text is not null")
    known = known.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES) or 1
    context = docs.sparkSession.sparkContext

    def found(block: int, everything: bool) -> DataFrame:
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        told = sorted((r["item_id"], r["text"]) for r in part.collect())  # at most about ITEM_BYTES
        shared = context.broadcast(told)
        kept: dict[str, tuple] = {}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if "tables" not in kept:
                kept["tables"] = tables_of(shared.value, n)
            tables, owners = kept["tables"]
            for batch in batches:
                texts = text_bytes(batch.column("text"))
                for a, b in chunks(texts):
                    got = list(search(texts[a:b], tables, owners))
                    keep = [i for i, g in enumerate(got) if everything or g[3]]
                    ids = [batch.column(c).slice(a, b - a).take(pa.array(keep, pa.int64())) for c in ("doc_id", *KEY)]
                    cols = [pa.array([got[i][j] for i in keep], t) for j, t in enumerate(TYPES)]
                    yield pa.RecordBatch.from_arrays([*ids, *cols], NAMES)

        return rows.mapInArrow(run, SCHEMA)

    out = found(0, True)
    if blocks > 1:
        out = written(out, "decontamination")
        more = [written(found(i, False), "decontamination").withColumn("block", F.lit(i)) for i in range(1, blocks)]
        rest = more[0]
        for part in more[1:]:
            rest = rest.unionByName(part)
        # Equal rows have equal hits; once per row of the first block's result, which has every row.
        rest = rest.dropDuplicates([*KEY, "block"]).groupBy(*KEY)
        rest = rest.agg(*[F.flatten(F.collect_list(c)).alias(f"more_{c}") for c in ("begins", "ends", "items")])
        out = out.join(rest, KEY, "left")
        for c in ("begins", "ends", "items"):
            both = F.concat(c, f"more_{c}")
            both = F.array_sort(F.array_distinct(both)) if c == "items" else both
            out = out.withColumn(c, F.when(F.col(f"more_{c}").isNull(), F.col(c)).otherwise(both))
    spots = F.transform(F.arrays_zip("begins", "ends"), lambda x: F.sequence(x["begins"], x["ends"] - 1))
    out = out.withColumn("n_hit", F.size(F.array_distinct(F.flatten(spots))).cast("long"))
    hit = (F.col("n_hit") > 0) & (F.col("n_hit") * 100 >= F.col("n_words") * percent)
    return out.select(
        "doc_id", *KEY, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        hit.alias("contaminated"),
    )


NAMES = ["doc_id", "k1", "k2", "n_words", "begins", "ends", "items"]
TYPES = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
