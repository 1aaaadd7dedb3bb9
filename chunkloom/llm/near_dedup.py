"""MinHash near-duplicates with circulant signatures, banding and exact Jaccard verification.

Two permutations make a whole signature: the first spreads the shingles over the circle of 32-bit numbers, the
second ranks its points, and coordinate k ranks them after a shift by k. Texts with the same set of shingles are
collapsed first. Every text is compared with two centres of its buckets: the one that shares most buckets with
others, which in a large group is the text that the others are copies of, and the centre of its smallest bucket.
Then, in buckets that still hold several components, members of different components are compared block against
block inside tasks: by their signatures, and where these agree well enough by their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, chunks, grams, mix, text_bytes, with_columns_renamed, words_of, written
from .components import components

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 4, 32  # a pair of similarity 0.75 shares no band with probability 5e-6
COORDINATES = ROWS * BANDS
AGREE = 0.58  # least share of equal coordinates of a pair worth comparing: 4.5 deviations below 0.75
PART = 128  # pairs of one text that are compared in one group
BLOCK = 1024  # texts of a bucket in one block, and their shingles
BLOCK_SHINGLES = 1 << 20


def _rank(x: np.ndarray) -> np.ndarray:
    """The second permutation: a bijection of 32-bit numbers."""
    x = x ^ (x >> np.uint32(16))
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words has none."""
    _, _, _, hashes, first = words_of([t.translate(LOWER) for t in texts])
    every = grams(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(every[a : b - n + 1]))
        else:
            out.append(grams(hashes[a:b], b - a) if b > a else hashes[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Circulant MinHash signature of each non-empty set, one row each."""
    lengths = np.array([len(s) for s in sets])
    begins = np.cumsum(lengths) - lengths
    points = (mix(np.concatenate(sets) ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), COORDINATES), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(COORDINATES):
            out[:, k] = np.minimum.reduceat(_rank(points + np.uint32(k)), begins)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band of each signature."""
    with np.errstate(over="ignore"):
        parts = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
        keys = np.zeros(parts.shape[:2], np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        for r in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys.view(np.int64)


SIGNED = "doc_id long, h long, n_shingles long, d1 long, d2 long, bands array<long>, low binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        for a, b in chunks(texts):
            sets = shingle_sets(texts[a:b])
            full = [i for i, s in enumerate(sets) if len(s)]
            bands, low = [[]] * len(sets), [None] * len(sets)
            if full:
                signed = signatures([sets[i] for i in full])
                for i, keys, row in zip(full, band_keys(signed).tolist(), signed.astype(np.uint8)):
                    bands[i], low[i] = keys, row.tobytes()
            with np.errstate(over="ignore"):
                d1 = [int(mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
                d2 = [int(mix(s ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(a, b - a),
                    batch.column("h").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(low, pa.binary()),
                ],
                ["doc_id", "h", "n_shingles", "d1", "d2", "bands", "low"],
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, part, b), the text of ``a`` itself first: exact comparison of a with each b."""
    now, mine = None, []
    for batch in batches:
        texts = text_bytes(batch.column("text"))
        left, part, right = (batch.column(c).to_pylist() for c in ("a", "part", "b"))
        found = []
        for i, j in chunks(texts):
            for at, have in zip(range(i, j), shingle_sets(texts[i:j])):
                key = (left[at], part[at])
                if right[at] is None:
                    # Rows that share an id are one node with several texts.
                    mine = [*mine, have] if key == now else [have]
                    now = key
                elif key == now:
                    for own in mine:
                        both = len(np.intersect1d(own, have, assume_unique=True))
                        if both and 100 * both >= PERCENT * (len(own) + len(have) - both):
                            found.append((left[at], right[at]))
                            break
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["a", "b"]
        )


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; each b's text travels once per pair.

    The pairs of one a are dealt in parts, each with a's own text, so that no part holds many rows.
    """
    parts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    parts = parts.select("a", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    own = parts.join(texts, F.col("a") == F.col("doc_id")).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "text"
    )
    other = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    other = other.join(texts, F.col("b") == F.col("doc_id")).select("a", "part", "b", "text")
    rows = own.unionByName(other).repartition("a", "part")
    rows = rows.sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return written(rows.mapInArrow(_compare, "a long, b long").distinct(), "links")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, i, j), two blocks of a bucket each: links that join different components.

    Signatures choose the pairs, full sets decide them. A link is given once for two components that it joins, so a
    group of rows has fewer links than rows.
    """
    group: list[tuple] = []
    now = None
    found: list[tuple[int, int]] = []

    def finish() -> None:
        texts = [g[4] for g in group]
        sets = [s for a, b in chunks(texts) for s in shingle_sets(texts[a:b])]
        ids, comp, block = (np.array([g[k] for g in group]) for k in range(3))
        low = np.frombuffer(b"".join(g[3] for g in group), np.uint8).reshape(len(group), COORDINATES)
        size = np.array([len(s) for s in sets])
        ends = np.cumsum(size)
        known, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        numbers = np.split(numbers, ends[:-1])
        mine = np.zeros(len(known), np.int64)
        least = int(np.ceil(AGREE * COORDINATES))
        for x in range(len(group) - 1):
            rest = slice(x + 1, None)
            ok = (comp[rest] != comp[x]) & (ids[rest] != ids[x])
            ok &= np.minimum(size[rest], size[x]) * 100 >= np.maximum(size[rest], size[x]) * PERCENT
            if now[1] != now[2]:
                ok &= block[rest] != block[x]
            at = np.flatnonzero(ok) + x + 1
            at = at[(low[at] == low[x]).sum(1) >= least]
            if not len(at):
                continue
            mine[numbers[x]] = 1
            both = np.add.reduceat(mine[np.concatenate([numbers[y] for y in at])], np.cumsum(size[at]) - size[at])
            mine[numbers[x]] = 0
            for y in at[100 * both >= PERCENT * (size[at] + size[x] - both)].tolist():
                if comp[y] != comp[x]:
                    comp[comp == comp[y]] = comp[x]
                    found.append((int(ids[x]), int(ids[y])))

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(2)], ["a", "b"])
        found.clear()
        return out

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("key", "i", "j", "doc_id", "component", "block", "low")]
        for key, i, j, *row in zip(*cols, text_bytes(batch.column("text"))):
            if (key, i, j) != now:
                if group:
                    finish()
                group, now = [], (key, i, j)
            group.append(row)
        yield flush()
    if group:
        finish()
        yield flush()


def settled(inside: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) across components in buckets that hold several, each bucket compared block against block.

    A text travels once for each block its own meets in a bucket, not once for each pair.
    """
    mixed = inside.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    whole = texts.join(classes.select("doc_id", "h", "low"), ["doc_id", "h"])
    rest = inside.join(mixed.select("key"), "key").join(whole, ["doc_id", "h"])
    count = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("doc_id"), count).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    rest = rest.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "doc_id", "component", "block", "low", "text",
    )
    rest = rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return written(rest.mapInArrow(_settle, "a long, b long").distinct(), "settled")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; A-Z count as lower case.

    Null texts and texts without words have no shingles and stay alone; rows that share an id are one node with
    the links of each; rows without id stay alone with a null component and are kept; exact copies are collapsed
    before pairs are made and come back by membership. Further columns are ignored; an empty table gives no rows.
    """
    rows = with_columns_renamed(docs, "doc_id", "text")
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    signed = written(rows.mapInArrow(_sign, SIGNED), "signatures")
    sets = signed.where("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "d1", "d2")
    # One row stands for all with its set; ids may repeat, so the hash of its text tells which row it is.
    classes = sets.agg(
        F.min(F.struct("doc_id", "h")).alias("rep"), F.any_value("bands").alias("bands"), F.any_value("low").alias("low")
    ).select("n_shingles", "d1", "d2", "rep.*", "bands", "low")
    classes = written(classes, "classes")

    keyed = classes.select(F.explode("bands").alias("key"), "doc_id", "h", "n_shingles")
    buckets = keyed.groupBy("key").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.sum("n_shingles").alias("total"),
        F.count("*").alias("n"), F.sum(F.xxhash64("doc_id", "h").cast("decimal(38,0)")).alias("who"),
    ).where("first < last")
    # Buckets of several bands that hold the same members count once.
    buckets = buckets.groupBy("first", "last", "n", "total", "who").agg(F.min("key").alias("key"), F.count("*").alias("bands"))
    members = written(keyed.drop("n_shingles").join(buckets.select("key", "n", "total", "bands"), "key"), "buckets")
    involved = members.select("doc_id").distinct()
    # The same plan at every size: a small side would be broadcast, one that grows with the corpus cannot be.
    texts = written(rows.join(involved.hint("merge"), "doc_id"), "texts")

    # Rows that share an id join the classes they belong to.
    shared = signed.join(classes.select("n_shingles", "d1", "d2", F.col("doc_id").alias("rep")), ["n_shingles", "d1", "d2"])
    shared = shared.where("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    # How many texts a text meets in all its buckets; a text has at most one bucket for each band.
    meets = F.sum(F.col("n") * F.col("bands")).over(Window.partitionBy("doc_id"))
    centres = members.withColumn("meets", meets).groupBy("key").agg(F.max(F.struct("meets", F.col("doc_id").alias("a"))).alias("c"))
    near = members.join(centres.select("key", "c.*"), "key").where("doc_id != a").groupBy("doc_id")
    near = near.agg(F.max(F.struct("meets", "a")).alias("most"), F.max(F.struct(-F.col("n"), "meets", "a")).alias("close"))
    stars = near.select(F.explode(F.array("most.a", "close.a")).alias("a"), F.col("doc_id").alias("b")).distinct()
    links = verified(stars, texts)
    joined = components(links, "a", "b").withColumnRenamed("node", "doc_id")
    inside = members.join(joined, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))

    more = settled(written(inside, "inside"), classes, texts)
    final = components(links.unionByName(more).unionByName(shared), "a", "b")
    out = signed.select("doc_id", "n_shingles").join(final, F.col("doc_id") == F.col("node"), "left")
    out = out.withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
