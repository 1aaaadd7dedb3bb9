"""Joins between items, artefacts, metadata and jobs.

No join carries a broadcast hint: the optimizer broadcasts a side only when its measured size allows
it and splits skewed partitions of the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths
from ..session import cut_lineage
from .segments import scan

try:
    import ahocorasick
except ImportError:  # without the automaton all key sets take the join
    ahocorasick = None


def attach_metadata(chunks: DataFrame, meta: DataFrame, longest: int | None = None) -> DataFrame:
    """Inner join of ordered chunks with one metadata row per document, balanced for large documents."""
    return scan(chunks, "doc_id", "pos", {}, attach=meta, longest=longest)


def attach_by_encoded_path(
    listing: DataFrame, meta: DataFrame, prefix: str = "", suffix: str = "", key: str = "doi"
) -> DataFrame:
    """Join on the key hidden in the path: cut the affixes, then decode twice."""
    decoded = paths.decode_key(paths.strip_affixes(F.col("path"), prefix, suffix))
    return listing.withColumn(key, decoded).join(meta, key)


def parent_stem(path: Column) -> Column:
    return F.concat_ws("/", paths.parent(path), paths.stem(path))


def path_index(listing: DataFrame) -> DataFrame:
    """First path per ``parent/stem`` key, with the number of paths that share the key."""
    return (
        listing.groupBy(parent_stem(F.col("path")).alias("key"))
        .agg(F.min("path").alias("path"), F.count("*").alias("n_paths"))
    )


def resolve_by_parent_stem(listing: DataFrame, items: DataFrame, key: str = "key") -> DataFrame:
    return items.join(path_index(listing).withColumnRenamed("key", key), key)


def duplicate_keys(listing: DataFrame) -> DataFrame:
    return path_index(listing).filter("n_paths > 1")


def pending_only(items: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Items without an artefact."""
    return items.join(done.select(key), key, "left_anti")


def present_in_both(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    return a.join(b.select(key), key, "left_semi")


def orphan_artifacts(listing: DataFrame, meta: DataFrame, key: str = "doc_id") -> DataFrame:
    """Artefacts without a metadata row. Rows only; nothing is deleted."""
    return listing.join(meta.select(key), key, "left_anti")


def exclude_blocklist(items: DataFrame, bad_ids: DataFrame, key: str = "doc_id") -> DataFrame:
    return items.join(bad_ids.select(key), key, "left_anti")


def diff_inventories(a: DataFrame, b: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys found on one side only: ``key, side``."""
    left = a.select(key).distinct().withColumn("_a", F.lit(True))
    right = b.select(key).distinct().withColumn("_b", F.lit(True))
    return (
        left.join(right, key, "full_outer")
        .filter(F.col("_a").isNull() | F.col("_b").isNull())
        .select(key, F.when(F.col("_b").isNull(), F.lit("only_a")).otherwise(F.lit("only_b")).alias("side"))
    )


def diff_summary(diff: DataFrame, key: str = "doc_id", sample: int = 100) -> DataFrame:
    """Number of keys per side and the first ``sample`` of them."""
    # Each task keeps only its smallest keys before they meet, so the sample stays small everywhere.
    smallest = diff.groupBy("side").agg(F.count("*").alias("n"))
    firsts = None
    for side in ("only_a", "only_b"):
        part = diff.filter(F.col("side") == side).orderBy(key).limit(sample)
        part = part.groupBy("side").agg(F.sort_array(F.collect_list(key)).alias("sample"))
        firsts = part if firsts is None else firsts.unionByName(part)
    return smallest.join(firsts, "side")


def rename_plan(listing: DataFrame, id_map: DataFrame, suffix: str = "") -> DataFrame:
    """``src, dst`` for files whose stem is a known old key; others are untouched."""
    old = listing.select(F.col("path").alias("src"), paths.stem(F.col("path")).alias("old_key"))
    ext = F.lit(suffix) if suffix else paths.extension(F.col("src"))
    return old.join(id_map, "old_key").select("src", F.concat(F.col("new_id").cast("string"), ext).alias("dst"))


# Keys up to this many bytes are sent to every task; larger key sets are joined instead.
MAX_KEY_BYTES = 4 * 1024 * 1024
# The filter of grams that is sent to every task takes 8 MiB at most, whatever the number of keys.
FILTER_BITS = 26
# A gram that more than this share of all lookups ask for is dealt over so many tasks; there can be 200 of them.
HOT_SHARE, SALTS = 0.005, 32
# Code points of a text that are hashed at once.
GRAM_BLOCK = 1 << 20


def semi_by_substring(
    items: DataFrame,
    keys: DataFrame,
    item_id: str = "path",
    text: str = "path",
    max_key_bytes: int = MAX_KEY_BYTES,
    gram: int = 12,
) -> DataFrame:
    """Items whose text contains at least one key; whole texts, no pairwise comparison.

    Every row is judged by its own text, so ids (``item_id``) may repeat or be null.
    """
    words = keys.select(F.col(keys.columns[0]).alias("_key")).filter(F.length("_key") > 0).distinct()
    size = words.agg(F.sum(F.octet_length("_key"))).first()[0] or 0
    if size <= max_key_bytes and ahocorasick is not None:
        return _match_sent_keys(items, [r[0] for r in words.collect()], text)
    return _match_joined_keys(items, words, text, gram)


def _match_sent_keys(items: DataFrame, words: list[str], text: str) -> DataFrame:
    sent = items.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not sent.value:
            yield from (pd.Series([False] * len(b)) for b in batches)
            return
        machine = ahocorasick.Automaton()
        for word in sent.value:
            machine.add_word(word, 1)
        machine.make_automaton()
        for texts in batches:
            yield texts.map(lambda t: t is not None and next(machine.iter(t), None) is not None)

    return items.filter(holds(F.col(text)))


def _gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each run of ``size`` code points."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(size))
    for j in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + points[j : j + n]
    total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(29))


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _gram_filter(anchors: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the anchors' grams as 64-bit words, and the number of leading bits of a hash that name a bit."""
    count = anchors.agg(F.count_distinct("_gram")).first()[0]
    bits = min(FILTER_BITS, max(10, (16 * count).bit_length()))
    slot = f"shiftrightunsigned(_gram, {64 - bits})"
    words = anchors.selectExpr(f"shiftright({slot}, 6) AS word", f"shiftleft(1L, cast({slot} & 63 AS int)) AS bit")
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(1 << (bits - 6), np.uint64)
    held[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return held, bits


def _match_joined_keys(items: DataFrame, words: DataFrame, text: str, gram: int) -> DataFrame:
    """Look every key up by the one of its character grams that fewest keys share.

    A filter of these grams is sent to the tasks, so that of a text only grams that may be a key's leave its task, and
    of the rows only those that have some. A text and a key meet when the text holds that gram; only such candidates
    are tested whole. A gram that very many texts hold is dealt over several tasks. Keys shorter than ``gram`` are
    looked up by their own length. Rows are known by a digest of their text; equal texts are looked up once.
    """

    @F.pandas_udf("array<bigint>")
    def key_grams(keys: pd.Series) -> pd.Series:
        points = keys.map(_code_points)
        return points.map(lambda p: np.unique(_gram_hashes(p, min(len(p), gram))).view(np.int64))

    size = F.least(F.length("_key"), F.lit(gram))
    parts = words.select("_key", size.alias("_size"), F.explode(key_grams("_key")).alias("_gram"))
    shared = parts.groupBy("_gram").agg(F.count("*").alias("_keys"))
    anchors = parts.join(shared, "_gram").groupBy("_key", "_size").agg(F.min_by("_gram", F.struct("_keys", "_gram")).alias("_gram"))
    anchors = cut_lineage(anchors)
    # At most `gram` different sizes exist, so this list is short.
    sizes = sorted(r[0] for r in anchors.select("_size").distinct().collect())
    held, bits = _gram_filter(anchors)
    sent = items.sparkSession.sparkContext.broadcast(held)

    def hits(value: str | None) -> np.ndarray:
        points, found = _code_points(value or ""), []
        for begin in range(0, len(points), GRAM_BLOCK):
            block = points[begin : begin + GRAM_BLOCK + gram - 1]
            for n in sizes:
                hashes = _gram_hashes(block, n)
                slots = hashes >> np.uint64(64 - bits)
                there = (sent.value[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1)
                found.append(np.unique(hashes[there == 1]))
        return np.unique(np.concatenate(found)).view(np.int64) if found else np.zeros(0, np.int64)

    @F.pandas_udf("array<bigint>")
    def text_grams(texts: pd.Series) -> pd.Series:
        return texts.map(hits)

    body = F.col(text)
    rows = items.select(F.struct(*[F.col(f"`{c}`") for c in items.columns]).alias("_item"), F.sha2(body, 256).alias("_row"), body.alias("_body"))
    rows = cut_lineage(rows.withColumn("_grams", text_grams("_body")).filter(F.size("_grams") > 0))
    bodies = rows.groupBy("_row").agg(F.any_value("_body").alias("_body"), F.any_value("_grams").alias("_grams"))
    probes = bodies.select("_row", F.explode("_grams").alias("_gram"))
    counts = probes.groupBy("_gram").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in counts.filter(F.col("n") > max(total * HOT_SHARE, 1000)).select("_gram").collect()]
    is_hot = F.col("_gram").isin(hot)
    salted = probes.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64("_row"), F.lit(SALTS))).otherwise(0).cast("int"))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    met = anchors.select("_gram", "_key", F.explode(salts).alias("_salt"))
    candidates = salted.join(met, ["_gram", "_salt"]).select("_row", "_key").distinct()
    holding = candidates.join(bodies.select("_row", "_body"), "_row").filter(F.contains(F.col("_body"), F.col("_key"))).select("_row")
    return rows.join(holding, "_row", "left_semi").select("_item.*")


def job_snapshot(jobs: DataFrame, docs: DataFrame, collections: DataFrame, stage: str) -> DataFrame:
    """Running jobs of a stage with their document and collection.

    ``jobs``: job_id, document_id, document_version, stage, status. ``docs``: document_id, version,
    collection_id, raw_uri, deleted_at, .... ``collections``: collection_id, collection_path, ....
    Adds the storage paths and ``error`` (no raw address, unusable collection path).
    """
    running = jobs.filter((F.col("stage") == stage) & (F.col("status") == "running"))
    alive = docs.filter(F.col("deleted_at").isNull())
    joined = running.join(alive, "document_id").filter(F.col("document_version") == F.col("version"))
    joined = joined.join(collections, "collection_id")
    storage = paths.collection_storage_path(F.col("collection_path"))
    missing = F.when(
        F.coalesce(F.col("raw_uri"), F.lit("")) == "",
        F.concat(F.lit("Document "), F.col("document_id").cast("string"), F.lit(" has no raw_uri.")),
    )
    return (
        joined.withColumn("_storage", storage)
        .withColumn("collection_storage_path", F.col("_storage.path"))
        .withColumn("processed_storage_path", paths.processed_storage_path(F.col("_storage.path")))
        .withColumn("error", F.coalesce(missing, F.col("_storage.error")))
        .drop("_storage")
    )


# Identity fields of a manifest in the order they are compared.
MANIFEST_FIELDS = [
    "document_id",
    "document_version",
    "artifact_uuid",
    "collection_path",
    "collection_storage_path",
    "processed_storage_path",
]


def first_mismatch(fields: list[str], left: str, right: str, code: str) -> Column:
    """``<code>: <field>`` for the first field that differs, null when all agree."""
    return F.coalesce(
        *[
            F.when(~F.col(f"{left}.{f}").eqNullSafe(F.col(f"{right}.{f}")), F.lit(f"{code}: {f}"))
            for f in fields
        ]
    )


def compare_manifests(local: DataFrame, remote: DataFrame, key: str = "document_id") -> DataFrame:
    """``key, error`` per local manifest; a missing remote manifest is an error of its own."""
    fields = [f for f in MANIFEST_FIELDS if f in local.columns]
    seen = remote.select(F.col(key).alias("_k"), F.struct(*[F.col(f) for f in fields]).alias("_r"))
    joined = local.select(F.col(key), F.struct(*[F.col(f) for f in fields]).alias("_l")).join(
        seen, F.col(key) == F.col("_k"), "left"
    )
    error = F.when(F.col("_k").isNull(), F.lit("S3_MANIFEST_MISSING")).otherwise(
        first_mismatch(fields, "_l", "_r", "S3_MANIFEST_MISMATCH")
    )
    return joined.select(key, error.alias("error"))


def verify_entries(entries: DataFrame, listing: DataFrame, strict: bool = False) -> DataFrame:
    """Check every manifest entry ``doc_id, role, name, size, sha256`` against ``doc_id, name, size, sha256``."""
    there = listing.select(
        "doc_id", "name", F.col("size").alias("_size"), *([F.col("sha256").alias("_sha")] if strict else [])
    )
    bad = F.when(F.col("_size").isNull(), F.concat(F.lit("LOCAL_ARTIFACT_MISSING: "), F.col("name"))).when(
        F.col("_size") != F.col("size"),
        F.concat(F.lit("S3_ARTIFACT_MISMATCH: "), F.col("name"), F.lit(" size")),
    )
    if strict:
        bad = bad.when(
            ~F.lower("_sha").eqNullSafe(F.lower("sha256")),
            F.concat(F.lit("S3_ARTIFACT_MISMATCH: "), F.col("name"), F.lit(" sha256")),
        )
    joined = entries.join(there, ["doc_id", "name"], "left")
    return joined.select(*[F.col(c) for c in entries.columns], bad.alias("error"))


def verify_artifacts(entries: DataFrame, listing: DataFrame, strict: bool = False) -> DataFrame:
    """One verdict per document: the error of its first failing entry, by role."""
    checked = verify_entries(entries, listing, strict)
    failing = F.when(F.col("error").isNotNull(), F.struct("role", "name"))
    return checked.groupBy("doc_id").agg(
        F.count("*").alias("n_entries"),
        F.count("error").alias("n_failed"),
        F.min_by("error", failing).alias("error"),
    )


def reuse_cached(listing: DataFrame, cache: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Add ``cached``: same path, same size and modification time within the tolerance."""
    known = cache.select(
        "path", F.col("size").alias("_size"), F.col("mtime").alias("_mtime"), F.lit(True).alias("_hit")
    )
    same = (F.col("size") == F.col("_size")) & (F.abs(F.col("mtime") - F.col("_mtime")) < tolerance)
    return listing.join(known, "path", "left").select(
        *listing.columns, F.coalesce(F.col("_hit") & same, F.lit(False)).alias("cached")
    )


def finalization_candidates(
    jobs: DataFrame,
    docs: DataFrame,
    collections: DataFrame,
    now: Column,
    limit: int | None = None,
    document_id=None,
) -> DataFrame:
    """Parse jobs that failed, died or lost their lease while the document shows no result yet."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    lease_over = F.col("locked_until").isNull() | (F.col("locked_until") < now)
    open_jobs = jobs.filter(
        (F.col("stage") == "parse")
        & (F.col("status").isin("failed", "dead") | ((F.col("status") == "running") & lease_over))
    )
    if document_id is not None:
        open_jobs = open_jobs.filter(F.col("document_id") == document_id)
    unfinished = docs.filter(
        F.col("deleted_at").isNull()
        & F.col("processed_manifest_local_uri").isNull()
        & F.col("processed_artifact_uuid").isNull()
    )
    joined = (
        open_jobs.join(unfinished, "document_id")
        .filter(F.col("document_version") == F.col("version"))
        .join(collections, "collection_id")
    )
    storage = paths.collection_storage_path(F.col("collection_path")).getField("path")
    out = joined.withColumn("collection_storage_path", storage).withColumn(
        "processed_storage_path", paths.processed_storage_path(F.col("collection_storage_path"))
    )
    return out if limit is None else out.orderBy("updated_at", "created_at").limit(limit)


def replayable(
    candidates: DataFrame, manifests: DataFrame, entries: DataFrame, listing: DataFrame, bucket: str, prefix: str
) -> DataFrame:
    """Candidates with a manifest, ``error`` or the ``payload`` that replays the finished parse."""
    fields = [f for f in MANIFEST_FIELDS if f in candidates.columns and f in manifests.columns]
    theirs = manifests.select(
        F.col("document_id").alias("_k"), F.struct(*[F.col(f) for f in fields]).alias("_m"), "artifact_uuid"
    )
    ours = candidates.withColumn("_c", F.struct(*[F.col(f) for f in fields]))
    joined = ours.join(theirs, F.col("document_id") == F.col("_k"))
    files = verify_artifacts(entries, listing).select(
        F.col("doc_id").alias("_d"), F.col("error").alias("_file_error")
    )
    joined = joined.join(files, F.col("document_id") == F.col("_d"), "left")
    error = F.coalesce(first_mismatch(fields, "_m", "_c", "MANIFEST_MISMATCH"), F.col("_file_error"))
    key = paths.manifest_key(prefix, F.col("processed_storage_path"), F.col("document_id"))
    payload = F.to_json(
        F.struct(
            "collection_path",
            "collection_storage_path",
            "processed_storage_path",
            key.alias("manifest_s3_key"),
            F.lit(bucket).alias("s3_bucket"),
            F.lit(prefix).alias("s3_prefix"),
            F.lit("parse_finalization_replay").alias("trigger"),
        )
    )
    return joined.select(
        *candidates.columns,
        "artifact_uuid",
        error.alias("error"),
        F.when(error.isNull(), payload).alias("payload"),
    )


def stale_done(listing: DataFrame, meta: DataFrame, cutoff: Column, at: str = "upload_time") -> DataFrame:
    """Ids with an artefact whose recorded stage time lies before the cutoff."""
    return meta.filter(F.col(at) < cutoff).join(listing.select("doc_id"), "doc_id", "left_semi").select("doc_id")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
