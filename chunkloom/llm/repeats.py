"""Finding the windows of a text that start anywhere else, with the exact test left to an operator.

Every window has an anchor: the smallest hash of the short grams inside it. Equal windows have equal anchors, so
only anchors that occur at two places of the corpus can belong to repeated windows. Consecutive windows with the
same anchor make a run; a run's text is a snippet. Snippets of one anchor meet in one shard, after equal ones were
counted together, and the operator's matcher decides exactly which windows of each snippet occur twice. Each window
of the corpus lies in exactly one run, so the weights of the snippets are the true numbers of occurrences. An
anchor with very many different snippets (the edge of a passage that stands in very many texts) has no shard that a
single task would have to gather: its windows are settled by ``settle``, which quarters ranges of windows and counts
digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, KEY, chunks, grams, row_key, text_bytes, with_columns_renamed, words_of, written

STEP = 2  # bits of the lead that one level decides
HOT = 300  # different snippets of an anchor above which it has no shard


@dataclass(frozen=True)
class Unit:
    """What windows consist of: words (texts joined by single spaces) or bytes."""

    words: bool
    window: int
    gram: int
    longest: int  # windows in one run at most

    def normal(self, text: bytes) -> bytes:
        return b" ".join(text.split()) if self.words else text

    def count(self, normal: bytes) -> int:
        if not self.words:
            return len(normal)
        return normal.count(b" ") + 1 if normal else 0

    def parts(self, texts: list[bytes]):
        """Hash of each unit of the texts, first unit of each text, and where units start and end in the joined bytes."""
        if self.words:
            joined, starts, ends, hashes, first = words_of(texts)
            return joined, hashes, first, starts, ends
        joined = b"".join(texts)
        first = np.cumsum([0] + [len(t) for t in texts])
        at = np.arange(len(joined))
        return joined, BYTE_VALUES[np.frombuffer(joined, np.uint8)], first, at, at + 1


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each ``width`` consecutive values, from running values in blocks of that width."""
    n = len(values)
    if n < width:
        return values[:0]
    fill = np.uint64(2**64 - 1) if pick is np.minimum else np.uint64(0)
    blocks = np.full(-(-n // width) * width, fill, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    upto = pick.accumulate(blocks, axis=1).ravel()
    after = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(after[: n - width + 1], upto[width - 1 : n])


def anchors(unit: Unit, hashes: np.ndarray, first: np.ndarray):
    """The anchor of each window, which windows lie within one text, and the hashes of all grams."""
    every = grams(hashes, unit.gram) | np.uint64(1)  # never 0, which stands for no window below
    least = sliding(every, unit.window - unit.gram + 1, np.minimum)
    inside = np.zeros(len(least) + 1, np.int32)
    long = first[1:] - first[:-1] >= unit.window
    np.add.at(inside, first[:-1][long], 1)
    np.add.at(inside, first[1:][long] - unit.window + 1, -1)
    return least, np.cumsum(inside[:-1]) > 0, every


def places(unit: Unit, texts: list[bytes]) -> list[list[int]]:
    """For each text the anchors of its windows, once for each place where they stand."""
    _, hashes, first, *_ = unit.parts(texts)
    if len(hashes) < unit.window:
        return [[] for _ in texts]
    least, inside, every = anchors(unit, hashes, first)
    width = unit.window - unit.gram + 1
    # A gram is a place of an anchor if it equals the anchor of a window that holds it.
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = np.where(inside, least, np.uint64(0))
    at = np.flatnonzero(sliding(padded, width, np.maximum) == every)
    values = every[at].view(np.int64)
    cut = np.searchsorted(at, first)
    return [values[a:b].tolist() for a, b in zip(cut[:-1], cut[1:])]


def digest(snippet: bytes) -> tuple[int, int]:
    """128 bits that stand for a snippet where its occurrences are counted or joined to its verdict."""
    code = hashlib.blake2b(snippet, digest_size=16).digest()
    return int.from_bytes(code[:8], "little", signed=True), int.from_bytes(code[8:], "little", signed=True)


def snippets(unit: Unit, texts: list[bytes], wanted: np.ndarray):
    """(text, first window, anchor, snippet) of each run of windows whose anchor is among ``wanted``."""
    joined, hashes, first, starts, ends = unit.parts(texts)
    if len(hashes) < unit.window:
        return
    least, inside, _ = anchors(unit, hashes, first)
    values = least.view(np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (values[1:] != values[:-1])
    # A text's first window begins a run even if the text before ends with the same anchor.
    heads = first[:-1][first[:-1] < len(begins)]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    stop = np.flatnonzero(inside & np.append(~inside[1:] | begins[1:], True)) + 1
    held = np.isin(values[at], wanted)
    at, stop = at[held], stop[held]
    docs = np.searchsorted(first, at, side="right") - 1
    for a, b, doc, value in zip(at.tolist(), stop.tolist(), docs.tolist(), values[at].tolist()):
        for s in range(a, b, unit.longest):
            e = min(s + unit.longest, b)
            yield doc, s - int(first[doc]), value, joined[starts[s] : ends[e + unit.window - 2]]


def ranges(unit: Unit, snippet: bytes, anchor: int, level: int, part: int):
    """(from, to, core, whole) of the ranges of windows in a part of a level.

    The lead of a window is the distance from its start to the first place of the anchor in it, which equal windows
    share. Part i of level t holds the leads from i * 2**t to below (i + 1) * 2**t. ``core`` is what all windows of
    the part around that place have in common, ``whole`` the text of the range.
    """
    joined, hashes, _, starts, ends = unit.parts([snippet])
    every = (grams(hashes, unit.gram) | np.uint64(1)).view(np.int64)
    spots = np.flatnonzero(every == anchor)
    at = np.arange(len(hashes) - unit.window + 1)
    lead = spots[np.searchsorted(spots, at)] - at
    mine = np.flatnonzero(lead >> level == part)
    if not len(mine):
        return
    fresh = np.append(True, (np.diff(mine) != 1) | (np.diff(lead[mine]) != -1))
    heads = np.flatnonzero(fresh)
    low, high = part << level, min(((part + 1) << level) - 1, unit.window - unit.gram)
    for a, b in zip(mine[heads].tolist(), (mine[np.append(heads[1:], len(mine)) - 1] + 1).tolist()):
        spot = a + int(lead[a])
        core = joined[starts[spot - low] : ends[spot - high + unit.window - 1]]
        yield a, b, b"%d %d %d " % (level, part, anchor) + core, b"%d %d " % (lead[a], anchor) + joined[starts[a] : ends[b + unit.window - 2]]


def settle(hot: DataFrame, unit: Unit) -> DataFrame:
    """Verdicts for distinct snippets (anchor, low, high, snippet, weight) of anchors that have very many.

    Ranges of windows are tested level by level. A range whose core occurs once holds no repeated window; a range
    that occurs twice as a whole holds only such, and one of its copies goes on for the others; the rest are cut in
    four, down to single windows. Each level has at most a few rows for a snippet, counted by 128-bit digests with
    partial sums, so no key has to be gathered; what is left of a level is written once for all that follows from it.
    The whole of a snippet is not tested: its core is the anchor alone, which all share.
    """
    levels = (unit.window - unit.gram).bit_length()
    level = (levels - 1) // STEP * STEP

    def cut(part: Column | int, n: int) -> Column:
        return F.explode(F.array(*[F.lit(part) * n + i for i in range(n)])).alias("part")

    parts = hot.select(*CODE, cut(0, 1 << (levels - level)))
    found = []
    while True:

        def probe(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = []
                for *code, part, snippet, weight in zip(*(batch.column(c).to_pylist() for c in (*CODE, "part", "snippet", "weight"))):
                    # Equal ranges of one snippet (a word repeated on and on) are one row.
                    equal: dict[tuple, list] = {}
                    for a, b, core, whole in ranges(unit, snippet, code[0], level, part):
                        equal.setdefault((*digest(core), *digest(whole)), []).append((a, b))
                    for codes, spots in equal.items():
                        begins, ends = [list(x) for x in zip(*spots)]
                        got.append((*code, part, begins, ends, *codes, weight * len(spots)))
                yield _batch(got, PROBE)

        rows = parts.join(hot, CODE).select(*CODE, "part", "snippet", "weight")
        rows = written(rows.mapInArrow(probe, PROBE), "probes")
        cores = rows.groupBy("c_low", "c_high").agg(F.sum("weight").alias("n")).where("n > 1").drop("n")
        rows = written(rows.join(cores, ["c_low", "c_high"]), "shared")
        if level == 0:
            found.append(rows.select(*CODE, "begins", "ends"))
            break
        wholes = rows.groupBy("w_low", "w_high").agg(F.sum("weight").alias("n"), F.min(F.struct(*CODE, "part")).alias("one"))
        wholes = wholes.where("n > 1").drop("n")
        found.append(rows.join(wholes, ["w_low", "w_high"]).select(*CODE, "begins", "ends"))
        rest = rows.join(wholes, ["w_low", "w_high"], "left_anti").select(*CODE, "part")
        # One range of each whole goes on too: others may share some of its windows only.
        going = rest.unionByName(wholes.select("one.*"))
        parts = written(going.select(*CODE, cut(F.col("part"), 1 << STEP)).distinct(), "parts")
        level -= STEP
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy(*CODE).agg(
        F.flatten(F.collect_list("begins")).alias("begins"), F.flatten(F.collect_list("ends")).alias("ends")
    )


# A matcher gets (snippet, weight) pairs that may share windows and gives for each the runs (from, to) of windows
# that occur at least twice in all of them.
Matcher = Callable[[list[tuple[bytes, int]]], list[list[tuple[int, int]]]]


def repeated(docs: DataFrame, unit: Unit, match: Matcher, shard_bytes: int) -> DataFrame:
    """doc_id, k1, k2, n, n_removed, n_spans, kept_sha256 of each row.

    Null texts are empty; equal rows repeat each other; texts shorter than a window have none. Memory in a task
    follows the longest text and ``shard_bytes``.
    """
    rows = with_columns_renamed(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), "text")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [unit.normal(t) for t in text_bytes(batch.column("text"))]
            for a, b in chunks(texts):
                part = texts[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(a, b - a) for c in ("doc_id", *KEY)),
                        pa.array([unit.count(t) for t in part], pa.int64()),
                        pa.array([hashlib.sha256(t).hexdigest() for t in part], pa.string()),
                        pa.array(places(unit, part), pa.list_(pa.int64())),
                    ],
                    ["doc_id", *KEY, "n", "sha", "anchors"],
                )

    seen = written(rows.mapInArrow(look, "doc_id long, k1 long, k2 long, n long, sha string, anchors array<long>"), "places")
    placed = seen.select(*KEY, F.explode("anchors").alias("anchor"))
    twice = placed.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    held = placed.distinct().join(twice, "anchor").groupBy(*KEY).agg(F.collect_list("anchor").alias("wanted"))
    texts = written(rows.select(*KEY, "text").join(held, KEY), "held")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [unit.normal(t) for t in text_bytes(batch.column("text"))]
            k1, k2 = (batch.column(c).to_pylist() for c in KEY)
            for a, b in chunks(texts):
                # An anchor that one text knows to occur twice does so for all texts of the chunk.
                wanted = np.unique(batch.column("wanted").slice(a, b - a).flatten().to_numpy(zero_copy_only=False))
                got, size = [], 0
                for doc, at, anchor, snippet in snippets(unit, texts[a:b], wanted):
                    got.append((k1[a + doc], k2[a + doc], at, anchor, *digest(snippet), snippet))
                    size += len(snippet)
                    if size > 1 << 22:
                        yield _batch(got, SNIPPET)
                        got, size = [], 0
                yield _batch(got, SNIPPET)

    cuts = written(texts.mapInArrow(cut, SNIPPET), "snippets")
    # Equal snippets are counted together before they meet their shard.
    distinct = written(cuts.groupBy(*CODE, "snippet").agg(F.count("*").alias("weight")), "distinct")
    hot = distinct.groupBy("anchor").count().where(F.col("count") > HOT).select("anchor")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by anchor; snippets of several anchors share a shard, up to its size."""
        group: list[tuple] = []
        size, now = 0, None

        def verdicts() -> pa.RecordBatch:
            runs = match([(g[3], g[4]) for g in group])
            keep = [i for i, r in enumerate(runs) if r]
            return _batch([(*group[i][:3], [r[0] for r in runs[i]], [r[1] for r in runs[i]]) for i in keep], VERDICT)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*CODE, "snippet", "weight"))):
                if row[0] != now and size >= shard_bytes:
                    yield verdicts()
                    group, size = [], 0
                now = row[0]
                group.append(row)
                size += len(row[3])
        if group:
            yield verdicts()

    shards = distinct.join(hot, "anchor", "left_anti").select(*CODE, "snippet", "weight")
    shards = shards.repartition("anchor").sortWithinPartitions(*CODE)
    verdict = shards.mapInArrow(judge, VERDICT)

    hot_snippets = written(distinct.join(hot, "anchor", "left_semi").select(*CODE, "snippet", "weight"), "hot")
    if not hot_snippets.isEmpty():
        verdict = verdict.unionByName(settle(hot_snippets, unit))
    verdict = written(verdict, "verdicts")
    found = cuts.select(*KEY, "at", *CODE).join(verdict, CODE)
    # Equal rows have equal runs; sets keep one of each.
    runs = found.groupBy(*KEY).agg(F.collect_set(F.struct("at", "begins", "ends")).alias("runs"))
    runs = runs.select(
        *KEY,
        F.flatten(F.transform("runs", lambda r: F.transform(r["begins"], lambda x: x + r["at"]))).alias("begins"),
        F.flatten(F.transform("runs", lambda r: F.transform(r["ends"], lambda x: x + r["at"]))).alias("ends"),
    )
    hit = texts.select(*KEY, "text").join(runs, KEY)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            out = []
            for text, begins, ends in zip(texts, batch.column("begins").to_pylist(), batch.column("ends").to_pylist()):
                out.append(removal(unit, unit.normal(text), begins, ends))
            cols = [pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in KEY), *cols], [*KEY, "n_removed", "n_spans", "kept"])

    done = hit.mapInArrow(remove, "k1 long, k2 long, n_removed long, n_spans long, kept string").dropDuplicates(KEY)
    return seen.select("doc_id", *KEY, "n", "sha").join(done, KEY, "left").select(
        "doc_id", *KEY, "n",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
    )


def removal(unit: Unit, text: bytes, begins: list[int], ends: list[int]) -> tuple[int, int, str]:
    """Removed units, removed runs and digest of what is left, for runs of repeated windows."""
    n = unit.count(text)
    covered = np.zeros(n + 1, np.int32)
    np.add.at(covered, np.array(begins, int), 1)
    np.add.at(covered, np.array(ends, int) + unit.window - 1, -1)
    gone = np.cumsum(covered)[:n] > 0
    if unit.words:
        words = text.split(b" ")
        left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
    else:
        left = np.frombuffer(text, np.uint8)[~gone].tobytes()
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, hashlib.sha256(left).hexdigest()


CODE = ["anchor", "low", "high"]
SNIPPET = "k1 long, k2 long, at int, anchor long, low long, high long, snippet binary"
VERDICT = "anchor long, low long, high long, begins array<int>, ends array<int>"
PROBE = (
    "anchor long, low long, high long, part int, begins array<int>, ends array<int>, "
    "c_low long, c_high long, w_low long, w_high long, weight long"
)
TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    arrays = [pa.array([r[j] for r in rows], TYPES[kind]) for j, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])
