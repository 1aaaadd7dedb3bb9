"""URL filters by a cascade of Bloom filters.

Level 1 holds the listed keys; level 2 the keys of the universe that level 1 takes for listed though they are not;
level 3 the listed keys that level 2 takes for false; and so on until no key is mistaken. A key's first level that
does not hold it decides: it is listed if that level is an even one. As the levels were built over all keys of the
corpus, the answer is exact for each of them, and pages are judged without a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_columns_renamed, written

# ---- fixed values: rules (verdict, host, path) of the contract.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
BITS_PER_KEY = 10
HASHES = 5
PART_BYTES = 16 << 20  # of filters that are sent to the tasks at once


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty for null and for urls without ``://``."""
    # RE: the text up to the first "://" cannot hold it, so the match is lazy.
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text and verdict; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


class Level:
    """One Bloom filter; a key is given by two hashes."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(-(-bits // 64), np.uint64)

    def holds(self, one: np.ndarray, two: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(one), bool)
        for i in range(HASHES):
            at = _place(one, two, level, i, self.bits)
            out &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out


def _place(one: np.ndarray, two: np.ndarray, level: int, i: int, bits: int) -> np.ndarray:
    """Bit that hash function ``i`` of a level gives each key."""
    with np.errstate(over="ignore"):
        x = one.view(np.uint64) + np.uint64(level * HASHES + i + 1) * (two.view(np.uint64) | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(bits)).astype(np.int64)


def _listed(levels: list[Level], one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether each key is listed: by the parity of the first level that does not hold it."""
    out = np.zeros(len(one), bool)
    open_ = np.arange(len(one))
    for depth, level in enumerate(levels):
        inside = level.holds(one[open_], two[open_], depth)
        out[open_[~inside]] = depth % 2 == 1
        open_ = open_[inside]
    out[open_] = len(levels) % 2 == 1
    return out


def _tester(levels: list[Level], depth: int | None = None):
    """Pandas UDF over the two hashes of keys: the cascade, or one level of it."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for one, two in batches:
            a, b = np.ascontiguousarray(one.to_numpy(np.int64)), np.ascontiguousarray(two.to_numpy(np.int64))
            got = _listed(levels, a, b) if depth is None else levels[depth].holds(a, b, depth)
            yield pd.Series(got)

    return F.pandas_udf(run, "boolean")


def _fill(keys: DataFrame, count: int, depth: int) -> Level:
    """The filter of a level over ``keys`` (one, two). Bits are set in tasks; words of bits come to the driver, at
    most as many bytes as the filter has."""
    level = Level(max(64, math.ceil(count * BITS_PER_KEY)))
    bits = level.bits

    def run(batches):
        for batch in batches:
            one = np.ascontiguousarray(batch["one"].to_numpy(np.int64))
            two = np.ascontiguousarray(batch["two"].to_numpy(np.int64))
            at = np.unique(np.concatenate([_place(one, two, depth, i, bits) for i in range(HASHES)])) if len(one) else np.zeros(0, np.int64)
            word, first = np.unique(at >> 6, return_index=True)
            with np.errstate(over="ignore"):
                mask = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(word) else np.zeros(0, np.uint64)
            yield pd.DataFrame({"word": word, "mask": mask.view(np.int64)})

    words = keys.select("one", "two").mapInPandas(run, "word long, mask long")
    for r in words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        level.words[r["word"]] = np.uint64(r["mask"] & (2**64 - 1))
    return level


def cascade(universe: DataFrame, depth_limit: int = 64) -> list[Level]:
    """Levels for keys (one, two, listed); ``universe`` holds each key once."""
    levels: list[Level] = []
    left = universe
    for depth in range(depth_limit):
        wanted = F.col("listed") if depth % 2 == 0 else ~F.col("listed")
        count = left.where(wanted).count()
        if not count:
            return levels
        levels.append(_fill(left.where(wanted), count, depth))
        # Go on with all keys that this level holds: those it should, and those it mistakes.
        left = written(left.where(_tester(levels, depth)("one", "two")), "cascade")
        if not left.where(~wanted).count():
            return levels
    raise RuntimeError("two keys share both hashes")


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("one"), F.xxhash64(key, F.lit("second")).alias("two")]


def members(keys: DataFrame, universe: DataFrame) -> DataFrame:
    """``keys`` (any columns, with one and two) and the column ``listed``.

    The cascade of a universe whose filters would exceed PART_BYTES is made in parts by hash and the rows pass
    through the parts one after another, so that what a task holds is bounded.
    """
    count = universe.where("listed").count()
    parts = -(-count * BITS_PER_KEY * 2 // 8 // PART_BYTES) or 1
    out = keys.withColumn("listed", F.lit(False))
    for part in range(parts):
        mine = F.pmod(F.col("one"), F.lit(parts)) == part
        levels = cascade(universe.where(mine))
        test = _tester(levels)("one", "two")
        out = out.withColumn("listed", F.when(mine, test).otherwise(F.col("listed")) if parts > 1 else test)
    return out


def judge(pages: DataFrame, listed: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row; ``listed`` has the hosts to block (column ``host``).

    The longest fitting rule decides; without one, hosts on the list are blocked and others allowed. Null urls and
    urls without ``://`` have empty host and path and are judged like others; null hosts on the list are ignored,
    repeated ones count once; repeated rows are judged each; an empty list blocks nothing; further columns are ignored.
    """
    rows = with_columns_renamed(pages, "page_id", "url")
    host, path = host_and_path(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    on_list = listed.select("host").where("host is not null").select("host", F.lit(True).alias("listed"))
    keys = rows.select("host", F.lit(False).alias("listed")).unionByName(on_list)
    universe = keys.groupBy("host").agg(F.bool_or("listed").alias("listed"))
    universe = written(universe.select(*hashes(F.col("host")), "listed"), "universe")
    tested = members(rows.select("*", *hashes(F.col("host"))), universe)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return tested.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def tracking_hosts(pages: DataFrame) -> DataFrame:
    """Hosts of which a third of the urls or more carry tracking parameters; the list the query uses."""
    host, _ = host_and_path(F.col("url"))
    tracked = F.coalesce(F.contains("url", F.lit("utm_")), F.lit(False))
    counts = pages.select(host.alias("host"), tracked.alias("tracked")).groupBy("host")
    counts = counts.agg(F.count("*").alias("n"), F.count_if("tracked").alias("t"))
    return counts.where("host != '' and 3 * t >= n").select("host")


