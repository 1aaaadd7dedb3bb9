"""Work lists cut into shards and batches, over one global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .segments import rank_all


def shard_round_robin(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    ranked = rank_all(df, *order)
    return ranked.withColumn("shard", ((F.col("rn") - 1) % n).cast("int")).drop("rn", "n_rows")


def shard_balanced(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Contiguous shards whose sizes differ by at most one, larger ones first."""
    ranked = rank_all(df, *order)
    size, extra = F.floor(F.col("n_rows") / n), F.col("n_rows") % n
    head = extra * (size + 1)
    at = F.col("rn") - 1
    shard = F.when(at < head, F.floor(at / (size + 1))).otherwise(
        extra + F.floor((at - head) / F.greatest(size, F.lit(1)))
    )
    return ranked.withColumn("shard", shard.cast("int")).drop("rn", "n_rows")


def shard_floor_tail(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Contiguous shards of ``floor(rows / n)``; the rest goes to the last one."""
    ranked = rank_all(df, *order)
    size = F.floor(F.col("n_rows") / n)
    shard = F.when(size == 0, F.lit(n - 1)).otherwise(
        F.least(F.floor((F.col("rn") - 1) / F.greatest(size, F.lit(1))), F.lit(n - 1))
    )
    return ranked.withColumn("shard", shard.cast("int")).drop("rn", "n_rows")


def shard_ceil(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Contiguous shards of ``ceil(rows / n)``; the last ones may be short or empty."""
    ranked = rank_all(df, *order)
    shard = F.floor((F.col("rn") - 1) / F.ceil(F.col("n_rows") / n))
    return ranked.withColumn("shard", shard.cast("int")).drop("rn", "n_rows")


def batch_ids(df: DataFrame, size: int, *order: Column | str) -> DataFrame:
    ranked = rank_all(df, *order)
    return ranked.withColumn("batch", F.floor((F.col("rn") - 1) / size)).drop("rn", "n_rows")


SHARD_POLICIES = {
    "round_robin": shard_round_robin,
    "balanced": shard_balanced,
    "floor_tail": shard_floor_tail,
    "ceil": shard_ceil,
}
