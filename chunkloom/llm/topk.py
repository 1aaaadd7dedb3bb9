"""Exact top-k search by inner product with a three-phase uniform threshold.

The coordinates are cut into slices; each slice of a block of vectors holds a list of local scores for a query.
Phase 1 gathers the best entries of every list, with their whole scores. The k-th best of these is a safe cutoff:
no vector of a lower score can be among the k best. A vector that reaches the cutoff must reach cutoff / slices in
one slice at least, as the slices' scores add up to its own; phase 2 sends each query's cutoff to all blocks and
collects the entries that do. Phase 3 resolves the whole scores of the collected entries exactly and ranks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import with_columns_renamed, written

K = 5
SLICES = 4
QUERY_ROWS, VECTOR_ROWS = 256, 4096  # rows of one block of queries and of vectors
LIMIT = 2.0**52


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, q (whole numbers) and dim of the usable rows: no null, none with null or non-finite components."""
    rows = with_columns_renamed(vectors, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where((F.size("embedding") > 0) & ~bad)
    q = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q")).withColumn("dim", F.size("q"))


def _blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Rows gathered in blocks of about ``size``: dim, block, ids and the matrix as bytes."""
    counts = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    dealt = rows.join(counts, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    return written(
        dealt.groupBy("dim", "block", "blocks").agg(F.collect_list(F.struct("vec_id", "q")).alias("rows")), name
    )


def _matrix(rows: pa.ListScalar, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a block, rows by id."""
    values = rows.values
    ids = values.field("vec_id").to_numpy(zero_copy_only=False)
    whole = values.field("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    order = np.argsort(ids, kind="stable")
    return ids[order], whole[order]


def local_scores(queries: np.ndarray, vectors: np.ndarray, slices: int) -> list[np.ndarray]:
    """Scores of all queries and vectors in each slice of the coordinates."""
    dim = queries.shape[1]
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * dim
    kind = np.float64 if reach < LIMIT else np.int64  # doubles are exact up to here, and fast
    q, v = queries.astype(kind), vectors.astype(kind)
    cuts = np.linspace(0, dim, min(slices, dim) + 1).astype(int)
    return [q[:, a:b] @ v[:, a:b].T for a, b in zip(cuts[:-1], cuts[1:])]


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores, ties to the earlier column."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, ties = np.flatnonzero(scores > least), np.flatnonzero(scores == least)
        keep = np.concatenate([above, ties[: k - len(above)]])
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((keep, -scores[keep]))][:k]


PAIR = "query_id long, vec_id long, score long"


def _entries(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    cols = [np.concatenate([f[j] for f in found]) if found else np.zeros(0, np.int64) for j in range(3)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], ["query_id", "vec_id", "score"])


def _scan(k: int, slices: int, final: bool):
    """Task of phase 1 (gather the heads of the lists) or of phases 2 and 3 (collect above the cutoff, resolve)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                q_ids, q = _matrix(batch.column("queries")[i], dim)
                v_ids, v = _matrix(batch.column("vectors")[i], dim)
                lists = local_scores(q, v, slices)
                whole = sum(lists[1:], lists[0])
                cutoffs = dict(batch.column("cutoffs")[i].as_py() or []) if final else {}
                found = []
                for row, query in enumerate(q_ids.tolist()):
                    other = np.flatnonzero(v_ids != query)
                    total = whole[row, other]
                    if final:
                        cutoff = cutoffs.get(query)
                        if cutoff is not None:
                            reach = np.zeros(len(other), bool)
                            for scores in lists:
                                reach |= scores[row, other] * len(lists) >= cutoff
                            other, total = other[reach], total[reach]
                            other, total = other[total >= cutoff], total[total >= cutoff]
                        keep = _best(total, k)
                    else:
                        keep = np.unique(np.concatenate([_best(s[row, other], k) for s in lists]))
                    found.append((np.full(len(keep), query), v_ids[other[keep]], total[keep]))
                yield _entries(found)

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, slices: int = SLICES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row for which ``is_query`` holds.

    Scores are inner products of floor(256 * x); ties go to the smaller id; with fewer rows all are given. Rows
    without id, null vectors and vectors with null or non-finite components take no part; vectors meet those of
    their own length; of queries that share an id the least vector asks; repeated rows are candidates each.
    An empty table gives no rows; further columns are ignored.
    """
    rows = written(quantised(vectors), "vectors")
    asking = rows.where(is_query).groupBy("vec_id", "dim").agg(F.min("q").alias("q"))
    asking = _blocks(asking.select("vec_id", "q", "dim"), QUERY_ROWS, "query-blocks")
    blocks = _blocks(rows, VECTOR_ROWS, "vector-blocks")
    q = asking.select("dim", F.col("block").alias("q_block"), F.col("rows").alias("queries"))
    v = blocks.select("dim", F.col("block").alias("v_block"), F.col("rows").alias("vectors"))
    # Each block of queries is dealt to the numbers of all blocks of vectors and meets each once.
    sent = q.join(blocks.select("dim", "blocks").distinct(), "dim")
    sent = sent.withColumn("v_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    heads = sent.join(v, ["dim", "v_block"]).mapInArrow(_scan(k, slices, False), PAIR)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    kth = written(heads.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k), "cutoffs")
    member = asking.select("dim", F.col("block").alias("q_block"), F.explode("rows.vec_id").alias("query_id"))
    cutoffs = member.join(kth.select("query_id", "score"), "query_id").groupBy("dim", "q_block")
    cutoffs = cutoffs.agg(F.collect_list(F.struct("query_id", "score")).alias("pairs"))
    cutoffs = cutoffs.withColumn("cutoffs", F.map_from_entries("pairs")).drop("pairs")

    full = sent.join(cutoffs, ["dim", "q_block"], "left").join(v, ["dim", "v_block"])
    got = full.mapInArrow(_scan(k, slices, True), PAIR)
    ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
